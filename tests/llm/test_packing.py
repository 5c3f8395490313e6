import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbra.llm import packing, tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_best_fit_against_brute_force(sizes):
    got = packing.best_fit_decreasing(np.array(sizes, dtype=np.int64), 50)
    bins, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = [left for left in bins if left >= sizes[i]]
        if fit:
            bins[bins.index(min(fit))] -= sizes[i]
        else:
            bins.append(50 - sizes[i])
        want[i] = 1
    used = {}
    for s, b in zip(sizes, got):
        used[b] = used.get(b, 0) + s
    assert sorted(50 - v for v in used.values()) == sorted(bins) and all(v <= 50 for v in used.values())


def test_round_trip(spark):
    r = random.Random(2)
    sizes = [r.choice([1, 7, 300, 999, 2047, 2048, 2049, 5000, 4096]) for _ in range(300)]
    rows = list(enumerate(sizes)) + [(1000, 0), (1001, None)]
    a = packing.packed(spark.createDataFrame(rows, "doc_id long, n_tokens long"), shard_items=100).collect()
    by, boxes = {}, {}
    for x in a:
        by.setdefault(x["doc_id"], []).append((x["parte"], x["desde"], x["n_tokens"]))
        boxes[x["contenedor"]] = boxes.get(x["contenedor"], 0) + x["n_tokens"]
    assert max(boxes.values()) <= 2048 and by.keys() == set(range(300))
    for d, s in enumerate(sizes):
        parts = sorted(by[d])
        assert sum(p[2] for p in parts) == s and (s > 2048 or len(parts) == 1)
        assert [p[1] for p in parts] == [2048 * i for i in range(len(parts))]
    assert packing.packed(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_repeated_rows_have_places_of_their_own(spark):
    rows = [(1, 2048), (1, 2048), (2, 5000), (2, 5000), (3, 1500), (3, 1500)]
    a = packing.packed(spark.createDataFrame(rows, "doc_id long, n_tokens long")).groupBy("contenedor").agg(F.sum("n_tokens").alias("t")).collect()
    assert max(r["t"] for r in a) <= 2048 and sum(r["t"] for r in a) == sum(n for _, n in rows)


def test_documents_fill(spark, data):
    docs = tokens.sized(spark.read.parquet(f"{data}/documents.parquet")).select("doc_id", "n_tokens")
    got = packing.fill(packing.packed(docs)).first()
    assert got["llenado"] > 0.9 and got["contenedores"] <= got["minimo"] + 1 and got["tokens"] == docs.agg(F.sum("n_tokens")).first()[0]


def test_sizes(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "hola, ¿qué tal?", 5), (4, "a" * 100_000, 5)], "doc_id long, text string, n int")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.sized(df).collect()}
    t = tokens.tokenizer(tokens.VOCABULARY)
    assert got[1] == got[2] == 0 and got[3] == len(t.encode_ordinary("hola, ¿qué tal?")) and t.decode(t.encode_ordinary("¿qué?")) == "¿qué?" and got[4] > 0
