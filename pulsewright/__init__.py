"""Spark-native feature pipelines over wearable heart-rate, sleep and meal tables.

Every public function takes DataFrames and returns a DataFrame; nothing is
collected to the driver and nothing holds a global session.
"""
