import random

import pytest
from pyspark.sql import functions as F

from siltworks.llm.splits import entity_components, placed, related_splits, rendezvous


def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"n{rnd.randrange(60):02d}", f"n{rnd.randrange(60):02d}") for _ in range(45)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)] + [("hub", f"l{i}") for i in range(25)]
    df = spark.createDataFrame(edges, "a string, b string")
    for heavy in (1, 20, 1000):
        got = {r["node"]: r["component"] for r in entity_components(df, heavy=heavy).collect()}
        assert got == union_find(edges)


def test_splits_keep_related_together(spark):
    rows = [(1, "s1", "u1"), (2, "s1", "u2"), (3, "s2", "u2"), (4, "s3", "u3"), (5, None, None), (6, "", None), (4, "s3", "u3"), (7, "s4", "u9"), (7, "s5", "u9")]
    df = spark.createDataFrame(rows, "record_id long, section string, url string").withColumn("split", F.lit("old")).withColumn("component", F.lit("old"))
    got = {r["record_id"]: (r["component"], r["split"]) for r in related_splits(df, "record_id", {"section": F.col("section"), "url": F.col("url")}).collect()}
    assert got[1] == got[2] == got[3] and got[4] != got[1] and got[5] != got[6]
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}
    assert related_splits(df.limit(0), "record_id", {"section": F.col("section")}).count() == 0


def test_rendezvous_shares_and_stability(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    shares = {r["s"]: r["count"] / 20000 for r in df.groupBy(rendezvous(F.col("k"), {"a": 0.8, "b": 0.1, "c": 0.1}).alias("s")).count().collect()}
    assert abs(shares["a"] - 0.8) < 0.02 and abs(shares["b"] - 0.1) < 0.01
    # a new split only takes over keys, it moves none between the others
    moved = df.select(rendezvous(F.col("k"), {"a": 1, "b": 1}).alias("x"), rendezvous(F.col("k"), {"a": 1, "b": 1, "z": 1}).alias("y")).where("x <> y and y <> 'z'").count()
    assert moved == 0
    with pytest.raises(ValueError):
        rendezvous(F.lit("x"), {})


def test_shares_hold_over_records(spark):
    rnd = random.Random(6)
    sizes = [250, 130, 90, 60] + [rnd.randrange(1, 12) for _ in range(300)]
    rows = [(f"{k}-{i}", f"s{k}") for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "record_id string, section string")
    for heavy in (100, 2000):
        got = related_splits(df, "record_id", {"section": F.col("section")}, heavy=heavy).collect()
        assert len(got) == len(rows) and len({(r["component"], r["split"]) for r in got}) == len(sizes)
        n = {s: sum(r["split"] == s for r in got) / len(rows) for s in ("train", "validation", "test")}
        # 300 small ones by hash, of 6 records on average: three standard deviations are 0.055
        near = {100: 0.055, 2000: 0.01}[heavy]
        assert abs(n["train"] - 0.8) < near and abs(n["validation"] - 0.1) < near


def test_placing_overfills_only_where_nothing_fits():
    at, left = placed([("a", 95), ("b", 5)], {"train": 0.8, "test": 0.2}, 100)
    assert at == {"a": "train", "b": "test"} and left == {"train": 0.0, "test": 15.0}
    assert placed([], {"x": 1.0}, 0) == ({}, {"x": 0.0})
