from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from lumbra.llm import residue as R


@pytest.fixture(scope="module")
def model(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.1')}/documents.parquet")
    return R.fitted(docs)


def _flag(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"] for r in R.scored(df, model[0]).where(f"puntaje >= {model[0].threshold}").collect()}


def test_unseen_hosts(model):
    m, s = model
    held = s[s["held"]]
    z, y = held["puntaje"].to_numpy() >= m.threshold, held["y"].to_numpy() == 1
    assert held["host"].nunique() >= 3 and (z & y).sum() >= 0.97 * y.sum() and (z & y).sum() >= 0.95 * z.sum()
    assert not set(held["host"]) & set(s[~s["held"]]["host"]) and m.bias < -1


def test_residue_in_short_and_long(spark, model):
    bad = [
        "404 - Página no encontrada. El documento solicitado no existe o fue movido.", "Please enable JavaScript to view this page.", "Estimado {{nombre}}: adjuntamos el detalle de <<PERIODO>> por [COMPLETAR].",
        "Lorem ipsum dolem amer consel velita tempra nostra.", "La mesa cerró el mes. " * 400 + "HTTP 503 Internal error. Request id 3ef52559. " + "La cartera rindió 4,70 %. " * 400,
        "Su sesión ha expirado.", "texto texto texto texto texto", "La mesa cerró el mes. " * 150_000 + "Bad gateway.",
    ]
    assert _flag(spark, model, bad) == set(range(len(bad)))


def test_talk_stays(spark, model):
    good = [
        "La cuenta 404 del plan agrupa los contratos forward con garantía.", "El portal devolvió un error 503 durante la descarga del 2026-03-29 y el equipo la repitió con éxito por la tarde.", "La plantilla usa %PERIODO% como variable y el sistema la llenó con 202501 en las 1979 cartas revisadas.",
        "Durante 202501 la cartera de renta fija local rindió 4,70 % y la extranjera 5,25 %.", "", None, " \n ", "x", "�" * 1000,
    ]
    assert _flag(spark, model, good) == set()


def test_ordinary_sentences_of_other_topics(spark, model):
    """Sentences that no generator of the test data wrote, in three languages, each a document and all in one."""
    lines = (Path(__file__).parent / "ordinary.txt").read_text().splitlines()
    assert len(lines) >= 200 and len(_flag(spark, model, lines)) <= 2
    z = model[0].score(R.cut([" ".join(lines)]))
    assert len(z) == len(lines) and (z >= model[0].threshold).sum() <= 2


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Dear {{name}}, your order {{order}} has shipped.", 1), ("Lorem ipsum dolor sit amet.", 1), ("503 Service Unavailable", 1), ("This site requires JavaScript.", 1), ("Please enable cookies in your browser.", 1), ("bla bla bla bla", 1),
        ("The server error was fixed on Monday.", 0), ("We had to enable JavaScript on every desk.", 0), ("O erro interno não afetou a carga.", 0), ("The sky is blue.", 0), ("Insert your key into the lock and turn it.", 0), ("See chapter {4} of the manual", None),
        ("Complete [NOMBRE] antes de firmar", 1),
    ],
)
def test_weak_labels(text, label):
    assert R.weak_label(text) == label


def test_passages():
    c = R.cut(["Uno dos. Tres S.A. de cuatro; Bco. Cinco.\nSeis?  Siete", "", "...", "Ocho Ltda. nueve. Diez Ltda. Once"])
    got = {}
    for i in range(len(c)):
        got.setdefault(int(c.doc[i]), []).append(c.passage(i))
    assert got == {0: ["Uno dos.", "Tres S.A. de cuatro; Bco. Cinco.", "Seis?", "Siete"], 2: ["..."], 3: ["Ocho Ltda. nueve.", "Diez Ltda.", "Once"]}
    assert len(R.cut([])) == 0 and len(R.cut(["", " "])) == 0


def test_score_is_that_of_the_rows(model):
    """Scores by segments of arrays equal those of each passage's own features, however the texts are batched."""
    m = model[0]
    texts = ["Su sesión ha expirado. La mesa cerró el mes de {{mes}} en <<x>>.", "Uno", "Please enable JavaScript."]
    c = R.cut(texts)
    idx, n = R.rows_of(c)
    ends = np.cumsum(n)
    want = [1 / (1 + np.exp(-(m.weights[idx[e - k : e]].sum() / np.sqrt(k) * 3 + m.bias))) for e, k in zip(ends, n)]
    assert np.allclose(m.score(c), want)
    assert np.allclose(np.concatenate([m.score(R.cut([t])) for t in texts]), want)


def test_long_texts_are_cut_between_passages(monkeypatch):
    text = "\n".join(f"línea número {i}" for i in range(2000))
    want = [c.passage(i) for c, _ in R._passages([text]) for i in range(len(c))]
    monkeypatch.setattr(R, "CHUNK", 500)
    got = [(c.passage(i), int(d[i])) for c, d in R._passages(["a", None, text, "b"]) for i in range(len(c))]
    assert [p for p, d in got if d == 2] == want and [g for g in got if g[1] != 2] == [("a", 0), ("b", 3)]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "hola", 5), (2, None, None)], "doc_id long, text string, rut_compania long")
    assert R.residue(df).count() == 0 and R.residue(df.limit(0)).count() == 0
    assert R.validation(df).count() == 1


def test_sample_is_bounded_and_repeatable(spark, data, monkeypatch):
    monkeypatch.setattr(R, "SAMPLE_PASSAGES", 50)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    a, b = R.sample(docs), R.sample(docs.repartition(7))
    assert len(a) == 50 and pd.DataFrame.equals(a, b)
