"""Session settings the pipelines rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Readings carry local wall-clock times without a zone. Bucket arithmetic goes
# through epoch seconds, so the session zone has to be UTC to leave them as is.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings in place and return the session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    With the setting unset, a session whose executors all live in the driver's
    process gets a local temporary folder; any other session is refused, as its
    executors would write to disks that nobody else reads.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"master is {master}: set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pulsewright-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
