import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbra.llm import mixing

GOAL = "source string, peso double, max_repeticiones int"


def test_splitting_tree_is_exact():
    counts = np.array([1000, 37, 0, 260])
    for shards in (1, 2, 7, 16):
        q = mixing.split_quotas(counts, shards)
        assert (q.sum(axis=0) == counts).all() and (q >= 0).all() and np.ptp(q.sum(axis=1)) <= 1 + np.log2(shards)
    assert (mixing.split_quotas(counts, 7) == mixing.split_quotas(counts, 7)).all()


def test_plan_quotas():
    blocks = {"a": np.full(64, 100), "b": np.full(64, 10)}
    plan = mixing.draw_plan(blocks, {"a": 0.8, "b": 0.2, "c": 0.5}, {"a": 1, "b": 2, "c": 1}, shard_tokens=500)
    took = {s: sum(t if t is not None else int(blocks[s][b]) for x, b, _, _, t in plan if x == s) for s in blocks}
    assert took == {"a": 5120, "b": 1280}
    assert len({(s, b, r) for s, b, r, _, _ in plan}) == len(plan) and {r for s, _, r, _, _ in plan if s == "b"} == {0, 1}
    assert mixing.draw_plan({}, {"a": 1.0}, {"a": 1}) == [] and mixing.draw_plan(blocks, {"a": 0.0}, {"a": 1}) == []


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens long, block string")


def test_shares_repeats_and_copies(spark):
    rows = [(i, f"a{i}", "a", 100 + i % 7, "x") for i in range(3000)] + [(10_000 + i, f"b{i % 400}", "b", 90, "x") for i in range(800)] + [(20_000 + i, f"c{i}", "zz", 5, "x") for i in range(9)] + [(30_000, "n", None, 5, "x"), (30_001, "e", "a", 0, "x")]
    goal = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 2), ("none", 0.4, 5)], GOAL)
    m = mixing.mixed(_docs(spark, rows), goal, shard_tokens=20_000)
    got = {r["source"]: r for r in mixing.shares(m, goal).collect()}
    assert got["a"]["parte"] == pytest.approx(0.7, abs=0.01) and got["b"]["parte"] == pytest.approx(0.3, abs=0.01) and got["none"]["tokens"] == 0
    assert got["a"]["usos"] == 1 and got["b"]["usos"] <= 2
    assert m.where("source = 'b'").select("doc_id").distinct().count() <= 400
    per = m.groupBy("shard").agg(F.count("*").alias("n"), F.max("orden").alias("o")).collect()
    assert len(per) > 1 and all(r["n"] == r["o"] for r in per)
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, mixing.mixed(_docs(spark, rows), goal, shard_tokens=20_000).collect()))


def test_more_shards_than_the_driver_plans(spark, monkeypatch):
    """Few blocks and groups, so that groups divide their finer blocks and the last block is cut in ranges: shares, repeats and shard sizes hold."""
    monkeypatch.setattr(mixing, "BLOCKS", 8)
    monkeypatch.setattr(mixing, "GROUPS", 4)
    monkeypatch.setattr(mixing, "CUT_ROWS", 50)
    rows = [(i, f"a{i}", "a", 100 + i % 7, "x") for i in range(6000)] + [(10_000 + i, f"b{i}", "b", 90, "x") for i in range(900)]
    goal = spark.createDataFrame([("a", 0.8, 1), ("b", 0.2, 3)], GOAL)
    m = mixing.mixed(_docs(spark, rows), goal, shard_tokens=10_000)
    got = {r["source"]: r for r in mixing.shares(m, goal).collect()}
    assert got["a"]["parte"] == pytest.approx(0.8, abs=0.002) and got["a"]["usos"] == 1 and got["b"]["usos"] <= 3
    per = m.groupBy("shard").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.max("orden").alias("o")).collect()
    assert len(per) > 40 and all(r["n"] == r["o"] for r in per) and max(r["t"] for r in per) < 20_000
    assert m.select("doc_id", "repeticion").distinct().count() == m.count()
    with pytest.raises(ValueError):
        monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
        mixing.mixed(_docs(spark, rows), goal)


def test_the_bound_of_sources_counts_no_null(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    goal = spark.createDataFrame([(None, 1.0, 1), ("a", 1.0, 1)], GOAL)
    assert mixing.mixed(_docs(spark, [(1, "t", "a", 5, "x"), (2, "u", None, 5, "x")]), goal).count() == 1


def test_empty(spark):
    goal = spark.createDataFrame([("a", 1.0, 1)], GOAL)
    assert mixing.mixed(_docs(spark, []), goal).count() == 0
    assert mixing.mixed(_docs(spark, [(1, "t", "a", 5, "x")]), goal.limit(0)).count() == 0
