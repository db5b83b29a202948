import random

from pulsewright.llm.graph import connected_components


def brute(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(500, 500 + i) for i in range(1, 60)]
    loose = [(r.randint(1000, 1060), r.randint(1000, 1060)) for _ in range(40)]
    links = [*chain, *hub, *loose, (7, 7), (None, 3), (4, None), (-5, 139), (-5, 139)]
    frame = spark.createDataFrame(links, "a long, b long")
    rows = connected_components(frame).collect()
    assert len(rows) == len({x["node"] for x in rows})
    assert {x["node"]: x["component"] for x in rows} == brute(links)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
