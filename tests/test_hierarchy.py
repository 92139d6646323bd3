import random

import pytest
from pyspark.sql import functions as F

from siltworks.operators import hierarchy as module
from siltworks.operators.hierarchy import hierarchy


def brute(parent):
    """node -> (root, depth, descendants, state) by walking."""
    par = {n: p if p in parent else None for n, p in parent.items()}
    members = set()
    out = {}
    for n in par:
        seen, x = [], n
        while x is not None and x not in seen:
            seen.append(x)
            x = par[x]
        if x is not None:
            ring = seen[seen.index(x):]
            members |= set(ring)
            out[n] = (min(ring), -1, "member" if n in ring else "below")
        else:
            out[n] = (seen[-1], len(seen) - 1, "none")
    kids = {}
    for n, p in par.items():
        kids.setdefault(p, []).append(n)

    def under(n):
        got, todo = set(), [n]
        while todo:
            for k in kids.get(todo.pop(), []):
                if k not in got:
                    got.add(k)
                    todo.append(k)
        return len(got - {n})

    return {n: (*v[:2], under(n), v[2]) for n, v in out.items()}


def run(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "url string, parent_url string")
    return {r["node"]: (r["root"], r["depth"], r["descendants"], r["cycle_state"]) for r in hierarchy(df, **kw).collect()}


@pytest.mark.parametrize("seed,local_rows", [(1, 1000), (2, 25), (3, 12)])
def test_random_graphs_over_partitions(spark, seed, local_rows):
    rnd = random.Random(seed)
    names = [f"n{i:03d}" for i in range(90)]
    parent = {}
    for i, n in enumerate(names):
        u = rnd.random()
        parent[n] = None if u < 0.05 else "gone" if u < 0.08 else names[rnd.randrange(max(1, i))] if u < 0.85 and i else rnd.choice(names)
    for a, b in zip(names[40:60], names[41:61]):
        parent[b] = a
    rnd.shuffle(names)
    assert run(spark, [(n, parent[n]) for n in names], local_rows=local_rows) == brute(parent)


def test_star_under_one_parent_and_long_chain(spark):
    parent = {"hub": "z0", **{f"s{i}": "hub" for i in range(60)}, **{f"z{i}": f"z{i + 1}" for i in range(40)}, "z40": None, "z7b": "z7"}
    assert run(spark, list(parent.items()), local_rows=25) == brute(parent)


def test_paths(spark):
    pairs = [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("w", "x"), ("q", "q"), ("d", "c"), ("e", " ")]
    for local_rows in (4, 100):
        df = spark.createDataFrame(pairs, "url string, parent_url string")
        got = {r["node"]: r["path"] for r in hierarchy(df, with_path=True, local_rows=local_rows, key=F.trim).collect()}
        assert got == {"a": ["a"], "b": ["a", "b"], "c": ["a", "b", "c"], "d": ["a", "b", "c", "d"], "e": ["e"], "x": None, "y": None, "w": None, "q": None}


def test_first_row_counts_and_odd_rows(spark):
    df = spark.createDataFrame(
        [("a", "b", 2), ("a", None, 1), ("b", "a", 3), ("b", "a", 3), (None, "a", 1), ("", "a", 1), ("c", "", None)],
        "url string, parent_url string, id int",
    )
    got = {r["node"]: (r["root"], r["depth"], r["descendants"], r["cycle_state"]) for r in hierarchy(df, order=[F.col("id")]).collect()}
    assert got == {"a": ("a", 0, 1, "none"), "b": ("a", 1, 0, "none"), "c": ("c", 0, 0, "none")}


def test_empty(spark):
    assert run(spark, []) == {}
    with pytest.raises(ValueError):
        run(spark, [], local_rows=0)


def test_more_groups_make_no_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(module, "MOST_TASKS", 5, raising=False)
    monkeypatch.setattr(module, "MOST_RANGES", 3, raising=False)
    rnd = random.Random(4)
    parent = {f"n{i:03d}": f"n{rnd.randrange(i):03d}" if i > 2 else None for i in range(120)} | {"n003": "n119"}
    spark.sparkContext.setJobGroup("crowd", "")
    got = run(spark, list(parent.items()), local_rows=10)
    spark.sparkContext.setJobGroup("rest", "")
    told = spark.sparkContext.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("crowd") for s in told.getJobInfo(j).stageIds]
    assert got == brute(parent)
    # a union reads what two stages left
    assert 1 < max(s.numTasks for s in stages if s) <= 10


def test_more_trees_than_a_group_holds(spark, monkeypatch):
    solve, levels = module._solve, []

    def counted(rows, n, local_rows, paths, level):
        levels.append(level)
        # trees alone were carried along for ever
        assert level < 8
        return solve(rows, n, local_rows, paths, level)

    monkeypatch.setattr(module, "_solve", counted)
    # parents and loops that lie in other groups than their children, and trees of one node
    parent = {f"a{i:02d}": None for i in range(15)} | {f"m{i:02d}": f"a{i:02d}" for i in range(12)} | {f"z{i:02d}": f"m{i % 9:02d}" for i in range(18)}
    parent |= {"b0": "y0", "y0": "b0", "x0": "y0", "c0": "c0"}
    assert run(spark, list(parent.items()), local_rows=5) == brute(parent)
    assert max(levels) > 1
    df = spark.createDataFrame(list(parent.items()), "url string, parent_url string")
    paths = {r["node"]: r["path"] for r in hierarchy(df, with_path=True, local_rows=5).collect()}
    assert paths["a14"] == ["a14"] and paths["z17"] == ["a08", "m08", "z17"] and paths["x0"] is None
