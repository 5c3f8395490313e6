import datetime as dt

import pytest
from pyspark.sql import functions as F

from lumbra.operators import cohorts, filters, flows, identity, publications, ranking, reconcile, resolve, rules, series
from lumbra.session import ship

D = dt.date


def test_flow_categories(spark):
    cols = "periodo int, rut_compania long, folio_operacion string, producto string, contraparte_key string, contraparte_grupo string, contraparte_nombre string, moneda string, fecha_vencimiento date, nocional_m double, mtm_neto_m double"
    row = lambda f, n, v=None, p="SWAP": (202501, 1, f, p, "A", "g", "n", "UF", v, n, 0.0)
    before = [row("act", 100.0), row("gone", 50.0, D(2030, 1, 1), "X"), row("mat", 60.0, D(2025, 1, 31), "X"), row("nul", 70.0, None, "X"), row("d1", 1000.0), row("d2", 1050.0)]
    now = [row("act", 110.0), row("new", 5.0, None, "X"), row("b1", 1010.0), row("b2", 1500.0)]
    got = flows.classify(spark.createDataFrame(now, cols), spark.createDataFrame(before, cols))
    cat = {(r["folio_operacion"]): (r["categoria"], r["folio_par"]) for r in got.collect()}
    assert cat == {"act": ("ACTIVE", None), "gone": ("UNWIND", None), "mat": ("MATURITY", None), "nul": ("UNWIND", None), "new": ("NEW", None), "d1": ("ROLL", "b1"), "b1": ("ROLL", "d1"), "d2": ("UNWIND", None), "b2": ("NEW", None)}
    shifted = spark.createDataFrame([(202412 if r in before else 202501, *r[1:]) for r in before + now] + [(202410, *now[0][1:])], cols)
    assert {tuple(r) for r in flows.classify(*flows.month_pairs(shifted)).collect()} == {tuple(r) for r in got.collect()}
    c = flows.cascade(got).first()
    assert c["apertura"] + c["nuevas"] + c["roll_entra"] - c["roll_sale"] - c["vencidas"] - c["deshechas"] + c["cambio_activas"] == pytest.approx(c["cierre"])


def test_current_publication_ties(spark):
    rows = [(202501, "a", D(2025, 2, 1)), (202501, "b", D(2025, 2, 1)), (202501, "b", D(2025, 2, 1)), (202502, "c", None), (202502, "d", D(2025, 3, 1))]
    df = spark.createDataFrame(rows, "periodo_informacion int, zip_origen string, fecha_descarga date")
    pubs = publications.ranked([df])
    assert {r["zip_origen"] for r in pubs.where("recencia = 1").collect()} == {"b", "d"}
    assert publications.current(df, pubs).count() == 3
    assert publications.latest_attribute(df, "zip_origen", "fecha_descarga", "periodo_informacion").count() == 3


def test_survival(spark):
    m = spark.createDataFrame([(1, 0, 100.0, 100.0), (1, 1, 50.0, 100.0), (1, 2, 25.0, 100.0), (2, 0, 100.0, 100.0), (2, 1, 100.0, 100.0)], "origen int, meses int, vivo double, originado double")
    assert [round(r["curva"], 6) for r in cohorts.chained_survival(m).orderBy("k").collect()] == [100.0, 75.0, 37.5]
    dead = m.union(spark.createDataFrame([(1, 3, 0.0, 100.0), (1, 4, 0.0, 100.0)], m.schema))
    assert [(r["k"], round(r["curva"], 6)) for r in cohorts.chained_survival(dead).orderBy("k").collect()] == [(0, 100.0), (1, 75.0), (2, 37.5), (3, 0.0)]


def test_extinct_cohort_stays(spark):
    ops = spark.createDataFrame([(202501, 202501, 10.0), (202502, 202503, 5.0)], "origen int, ultima int, monto double")
    shots = spark.createDataFrame([(p,) for p in (202501, 202502, 202503)], "foto int")
    got = {(r["origen"], r["foto"]): r["vivo"] for r in cohorts.survival_matrix(ops, shots, ["origen"]).collect()}
    assert got == {(202501, 202501): 10.0, (202501, 202502): 0.0, (202501, 202503): 0.0, (202502, 202502): 5.0, (202502, 202503): 5.0}


def test_pinned_rank(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 1.0), ("d", 0.0), ("p", 0.5)], "k string, v double")
    got = {r["k"]: (r["v"], r["puesto"]) for r in ranking.pinned_top(df, "k", "v", 2, "p").collect()}
    assert got == {"b": (9.0, 1), "a": (5.0, 2), "p": (0.5, 4), "Resto": (1.0, None), "Total": (15.5, None)}


def test_verdicts(spark):
    df = spark.createDataFrame([(1, 100.0, 100.4), (2, 100.0, 150.0), (3, None, 1.0)], "id int, a double, b double")
    got = {r["id"]: r["veredicto"] for r in rules.judged(df, [rules.check("eq", F.lit(True), F.col("a"), F.col("b"), absolute=1.0)]).collect()}
    assert got == {1: "pass", 2: "quarantine", 3: "unverified"}
    cost = spark.createDataFrame([(1, 100.0, 30.0, 70.5), (2, 100.0, None, 100.0), (3, 100.0, 30.0, 80.0), (4, None, 1.0, 1.0)], "id int, a double, b double, c double")
    assert {r["id"]: r["veredicto"] for r in rules.judged(cost, [rules.difference("costo", F.lit(True), F.col("a"), F.col("b"), F.col("c"))]).collect()} == {1: "pass", 2: "pass", 3: "quarantine", 4: "unverified"}
    uf = spark.createDataFrame([(1, 7600.0, 200.0), (2, 7800.0, 200.0), (3, 38.0, 1.0), (4, None, 200.0), (5, 7600.0, 0.0)], "id int, mp double, um double")
    assert {r["id"]: r["veredicto"] for r in rules.judged(uf, [rules.unit_price("uf", F.lit(True), F.col("mp"), F.col("um"), F.lit(38000.0), scale=1000.0, least=100.0)]).collect()} == {1: "pass", 2: "quarantine", 3: "unverified", 4: "unverified", 5: "unverified"}
    assert rules.judged(df, []).where("veredicto = 'unverified'").count() == 3


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, y string")
    assert filters.narrowed(df, {"y": filters.among("y", ["a", "b"], ["a", "b"])})[0].count() == 3
    assert filters.narrowed(df, {"y": filters.among("y", [], ["a"])})[0].count() == 0
    named = filters.renamed({"numero": (2, 3, 1, 9), "letra": (["a", "b"], ["a", "b", "c"]), "otra": (["a"], ["a", "b"])}, {"numero": "x", "letra": "y"})
    assert [r["x"] for r in filters.narrowed(df, named)[0].collect()] == [2] and filters.narrowed(df, named)[1] == ["otra"]
    got, omitted = filters.narrowed(df, {"x": filters.between("x", 2, 9, 1, 9), "z": F.lit(False)})
    assert got.count() == 2 and omitted == ["z"]


@pytest.mark.parametrize(
    "bad",
    [
        "DROP TABLE t", "SELECT 1; DELETE FROM t", "SELECT * FROM secret", "INSERT INTO t VALUES (1)", "WITH a AS (SELECT 1) SELECT * FROM other, a", "SELECT * FROM t, csv.`/etc/passwd`",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM t", "SELECT TRANSFORM(id) USING 'cat' FROM t", "SELECT * FROM range(9)", "SELECT * FROM IDENTIFIER('secret')", "SELECT id FROM t WHERE id IN (SELECT id FROM secret)",
        "SELECT (SELECT max(input_file_name()) FROM t)", "SELECT * FROM (WITH secret AS (SELECT 1) SELECT * FROM secret) x, secret", "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret", "SELECT my_own(id) FROM t", "VALUES (1); SELECT 1", "SELECT ((",
    ],
)
def test_gate_refuses(spark, bad):
    spark.range(1).createOrReplaceTempView("t")
    with pytest.raises(ValueError):
        filters.gated(spark, bad, {"t"})


def test_selections_of_a_fact(spark):
    df = spark.createDataFrame([(1, "SWAP", D(2026, 1, 1), "Banco Uno", None), (2, "PACTO", None, "Otro", "AA"), (3, "SWAP", D(2031, 1, 1), None, "AA")], "line_no int, producto string, fecha_vencimiento date, contraparte_nombre string, clasificacion_riesgo string")
    pick = lambda **c: sorted(r["line_no"] for r in filters.selected(df, "fact_derivado", c)[0].collect())
    assert pick() == [1, 2, 3] and pick(producto=(["SWAP"], ["SWAP", "PACTO"])) == [1, 3] and pick(producto=([], ["SWAP"])) == []
    assert pick(vencimiento=(D(2026, 1, 1), D(2030, 1, 1), D(2000, 1, 1), D(2100, 1, 1))) == [1] and pick(vencimiento=(D(2000, 1, 1), D(2100, 1, 1), D(2000, 1, 1), D(2100, 1, 1))) == [1, 2, 3]
    assert pick(contraparte="BANCO") == [1] and pick(contraparte="  ") == [1, 2, 3] and pick(calificada=True) == [2, 3] and pick(calificada=False) == [1] and pick(calificada=None) == [1, 2, 3]
    assert filters.selected(df, "fact_derivado", {"nada": 1, "moneda": (["UF"], ["UF", "CLP"]), "producto": (["SWAP"], ["SWAP"])})[1] == ["moneda", "nada"]
    assert filters.arranged(df, ["producto", "zzz", "line_no"], {"clasificacion_riesgo"}).columns == ["producto", "line_no", "fecha_vencimiento", "contraparte_nombre"]


def test_gate_allows(spark):
    spark.range(3).createOrReplaceTempView("t")
    assert filters.gated(spark, "WITH a AS (SELECT id, 'drop; x' AS s FROM t) SELECT * FROM a", {"t"}).count() == 3
    many = "WITH a AS (SELECT id FROM T WHERE id IN (SELECT max(id) FROM t)), b AS (SELECT * FROM a) SELECT x.id, count(*) AS n, row_number() OVER w AS r FROM b x LEFT JOIN t y USING (id) GROUP BY x.id HAVING count(*) > 0 WINDOW w AS (ORDER BY x.id) ORDER BY 1 LIMIT 5"
    assert [tuple(r) for r in filters.gated(spark, many, {"t"}).collect()] == [(2, 1, 1)]
    assert filters.gated(spark, "SELECT id FROM t UNION SELECT id + 9 FROM t EXCEPT SELECT 1", {"t"}).count() == 5


def test_resolution(spark):
    cat = spark.createDataFrame([("BCH", 97, "Banco de Prueba", None), ("OTR", None, "Compania Metalurgica Andina", "LEI1"), ("OTR2", None, "Otra Cosa", None)], "entity string, rut long, alias string, identifier string")
    rows = spark.createDataFrame([(1, 97, "x", None), (2, None, "BANCO DE PRUEBA SA", None), (3, None, "zzz", "LEI1"), (4, None, "Compania Metalurgica Andinas", None), (5, None, "Nadie", None), (6, None, None, None)], "id int, rut long, name string, identifier string")
    got = {r["id"]: (r["entidad"], r["metodo"]) for r in resolve.cascade(rows, cat, ["id"]).collect()}
    assert got == {1: ("BCH", "rut"), 2: ("BCH", "alias"), 3: ("OTR", "identifier"), 4: ("OTR", "fuzzy"), 5: (None, "unresolved"), 6: (None, "unresolved")}


def test_reconcile_and_series(spark):
    a = spark.createDataFrame([(1, "k", D(2025, 1, 1)), (2, "k", D(2025, 1, 7))], "a int, k string, d date")
    b = spark.createDataFrame([(10, "k", D(2025, 1, 5)), (11, "k", D(2025, 1, 20))], "b int, k string, e date")
    assert [tuple(r) for r in reconcile.one_to_one(a, b, ["k"], "a", "b", "d", "e", 5).collect()] == [(2, 10, 2)]
    s = spark.createDataFrame([(D(2025, 1, 10), 1.0), (D(2025, 3, 1), 2.0), (D(2025, 3, 1), 1.5)], "fecha date, valor double")
    e = spark.createDataFrame([(i, D(2025, m, d)) for i, (m, d) in enumerate([(1, 9), (1, 10), (2, 28), (3, 1), (12, 31)])], "id int, ts date")
    assert {r["id"]: r["valor"] for r in series.value_as_of(e, s, "ts").collect()} == {0: None, 1: 1.0, 2: 1.0, 3: 2.0, 4: 2.0}
    far = spark.createDataFrame([(0, D(1700, 1, 1)), (1, D(1960, 2, 29)), (2, D(2400, 1, 1)), (3, None)], "id int, ts date")
    old = s.union(spark.createDataFrame([(D(1800, 5, 1), 0.5)], s.schema))
    assert {r["id"]: r["valor"] for r in series.value_as_of(far, old, "ts").collect()} == {0: None, 1: 0.5, 2: 2.0, 3: None}
    assert {r["valor"] for r in series.value_as_of(e, s.limit(0), "ts").collect()} == {None}
    assert {r["periodo"]: r["valor"] for r in series.month_close(s).collect()} == {202501: 1.0, 202503: 2.0}


def test_global_rank_with_ties_nulls_and_a_hot_value(spark):
    import random

    r = random.Random(4)
    vals = [None if r.random() < 0.1 else 5.0 if r.random() < 0.4 else round(r.uniform(-50, 50), 1) for _ in range(500)]
    df = spark.createDataFrame([(f"k{i:03d}", v) for i, v in enumerate(vals)], "k string, v double")
    for down in (False, True):
        got = {x["k"]: x["_rank"] for x in ranking.global_rank(df, "v", "k", descending=down).collect()}
        want = sorted(got, key=lambda k: (vals[int(k[1:])] is None, (-1 if down else 1) * (vals[int(k[1:])] or 0.0), k))
        assert [got[k] for k in want] == list(range(1, 501))
    assert ranking.global_rank(df.limit(0), "v", "k").count() == 0


def test_quantiles_and_ranks_by_group_against_brute_force(spark):
    import random

    import numpy as np

    r = random.Random(5)
    rows = [(r.choice(["a", "b", "b", "b", None]), f"k{i}", r.choice([None, float("nan"), 7.0, 7.0, round(r.uniform(-9, 9), 2)])) for i in range(400)] + [("solo", "z", 3.0)]
    df = spark.createDataFrame(rows, "g string, k string, v double")
    got = {x["g"]: (x["p25"], x["mediana"]) for x in ranking.quantiles(df, ["g"], "v", {"p25": 0.25, "mediana": 0.5}).collect()}
    for g in ("a", "b", "solo"):
        own = [v for h, _, v in rows if h == g and v is not None and v == v]
        assert got[g] == pytest.approx(tuple(np.quantile(own, [0.25, 0.5])))
    places = {(x["g"], x["k"]): x["puesto"] for x in ranking.positive_rank(df.where("NOT isnan(v) OR v IS NULL"), "v", "k", ["g"]).collect()}
    for g in ("a", "b", None):
        own = sorted((k for h, k, v in rows if h == g and v is not None and v > 0), key=lambda k: (-dict((k, v) for _, k, v in rows)[k], k))
        assert [places[g, k] for k in own] == list(range(1, len(own) + 1))
    assert all(places[g, k] is None for g, k, v in rows if v is None or v <= 0)
    assert ranking.quantiles(df.limit(0), ["g"], "v", {"x": 0.5}).count() == 0


def test_mutual_nearest_against_brute_force(spark):
    import random

    r = random.Random(8)
    for hot in (False, True):
        rows = lambda n, p: [(r.choice([1, 2]), f"{p}{i}", float(r.choice([100, 105, 110, 111, 90, 91, 1000, 1090, -50, -52, 0]) if not hot else round(r.uniform(90, 400), 1))) for i in range(n)]  # noqa: E731, B023
        left, right = rows(60, "l"), rows(60, "r")
        best = lambda mine, others, flip: min(((abs(o[2] - mine[2]), o[1]) for o in others if o[0] == mine[0] and mine[2] and o[2] and mine[2] * o[2] > 0 and abs(o[2] - mine[2]) <= 0.1 * abs(o[2] if flip else mine[2])), default=None)
        want = set()
        for x in left:
            b = best(x, right, False)
            if b:
                y = next(o for o in right if o[1] == b[1])
                back = best(y, left, True)
                if back and back[1] == x[1]:
                    want.add((x[1], y[1]))
        s = "g int, k string, v double"
        got = {(x["_l"], x["_r"]) for x in flows.mutual_nearest(spark.createDataFrame(left, s), spark.createDataFrame(right, s), ["g"], "k", "v", 0.1).collect()}
        assert got == want and len(want) > 5


def test_cohorts_of_all_years_against_brute_force(spark, tmp_path):
    import __spark_entry__ as entry

    orders = [(1, D(1995, 3, 9), 100.0), (2, D(1995, 3, 30), 40.0), (3, D(1996, 12, 31), 7.5), (4, D(1997, 1, 1), 60.0), (5, D(1998, 7, 2), 20.0)]
    lines = [(1, D(1995, 3, 20)), (1, D(1997, 2, 1)), (2, D(1995, 4, 2)), (3, D(1997, 1, 15)), (4, D(1996, 12, 1)), (5, D(1998, 8, 1))]
    spark.createDataFrame([(k, dt.datetime(d.year, d.month, d.day), m) for k, d, m in orders], "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, dt.datetime(d.year, d.month, d.day)) for k, d in lines], "l_orderkey long, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    month = lambda d: d.year * 100 + d.month
    ops = [(month(d), max([month(d), *(month(s) for k, s in lines if k == o)]), m) for o, d, m in orders]
    shots = sorted({o for o, _, _ in ops})
    want = {(o, f): sum(m for a, z, m in ops if a == o and z >= f) for o in shots for f in shots if f >= o}
    run = lambda name: entry.queries()[name](spark, str(tmp_path))
    assert {(r["origen"], r["foto"]): r["vivo"] for r in run("cohort_matrix").collect()} == want
    assert {r["origen"]: (r["operaciones"], r["originado"], r["vivas"]) for r in run("cohort_summary").collect()} == {
        o: (sum(a == o for a, _, _ in ops), sum(m for a, _, m in ops if a == o), sum(a == o and z >= 199807 for a, z, _ in ops)) for o in shots
    }
    months = lambda o, f: (f // 100 - o // 100) * 12 + f % 100 - o % 100
    by = {(o, months(o, f)): v for (o, f), v in want.items()}
    curve, value = {0: 100.0}, 100.0
    for k in sorted({k for _, k in by} - {0}):
        both = [o for o in shots if (o, k) in by and (o, k - 1) in by]
        if both and sum(by[o, k - 1] for o in both) > 0:
            value *= sum(by[o, k] for o in both) / sum(by[o, k - 1] for o in both)
            curve[k] = value
    assert {r["k"]: pytest.approx(r["curva"]) for r in run("survival_curve").collect()} == curve


def test_control_total_of_trailers_with_commas_and_blanks(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [("z", f, n, "C", raw.ljust(138)) for f, lines in {"plain": ["3000012"], "comma": ["3,,,,12"], "blank": ["3"], "bad": ["30000x2"]}.items() for n, raw in enumerate([*lines, "2x", "2y"])]
    spark.createDataFrame(rows, "zip_origen string, source_file string, line_no int, formato string, raw string").coalesce(1).write.parquet(f"{tmp_path}/parsed_record.parquet")
    got = {r["source_file"]: (r["declarado"], r["contado"]) for r in entry.queries()["control_total"](spark, str(tmp_path)).collect()}
    assert got == {"plain": (12, 2), "comma": (12, 2), "blank": (0, 2), "bad": (None, 2)}


def test_legal_identity(spark):
    rows = [
        (1, 97006000, "6", None, "Banco Uno"), (2, 97006000, "1", None, "Banco Uno"), (3, 0, None, "5493001KJTIIGC8Y1R12", "Other Name"), (4, None, "", "5493001KJTIIGC8Y1R13", "Dos Sa"), (5, None, None, "0", "Banco Tres S.A."),
        (6, None, None, None, "BANCO TRES"), (7, 97006000, "6", None, "Bco Uno"), (8, 97006000, "6", None, "Banco Uno"), (9, None, None, "549300DTUYXVMJXZNY75", "DOS"), (10, None, None, " ", None),
    ]
    df = spark.createDataFrame([(*r, "g" if r[0] in (1, 3) else None) for r in rows], "id int, rut long, verificador string, lei string, nombre string, grupo string")
    reg = spark.createDataFrame([("5493001KJTIIGC8Y1R12", "LAPSED", "Andina Trust", None)], "lei string, estado_lei string, nombre_legal string, categoria string")
    got = {r["id"]: (r["tipo"], r["entidad"], r["nombre"], r["alertas"]) for r in identity.identified(df, ["id"], reg, "grupo").collect()}
    assert got[1] == ("RUT", "RUT 97006000-6", "Banco Uno", "grupo_con_varios") and got[7] == ("RUT", "RUT 97006000-6", "Banco Uno", "")
    assert got[2] == ("RUT invalido", "RUT invalido 97006000-1", "Banco Uno", "rut_invalido")
    assert got[3] == ("LEI", "LEI 5493001KJTIIGC8Y1R12", "Andina Trust", "lei_no_vigente;lei_de_vehiculo;lei_de_otro;grupo_con_varios")
    assert got[4][0] == "LEI invalido" and got[4][3] == "lei_invalido;nombre_con_varios_lei" and got[9][3].endswith("nombre_con_varios_lei")
    assert got[5][1] == got[6][1] == "NOMBRE BANCO TRES" and got[5][3] == "sin_identificador" and got[10][1] == "NOMBRE (vacio)"
    assert identity.identified(df.limit(0), ["id"]).count() == 0


def test_unique_keys_and_controls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    assert publications.only_once(df, ["k"]) is df
    with pytest.raises(ValueError):
        publications.only_once(df.union(df), ["k"])
    one = lambda x: spark.createDataFrame([(x,)], "x double")
    got = {r["control"]: r["iguales"] for r in rules.agreement({"a": (one(1.0), one(1.005)), "b": (one(1.0), one(1.1)), "c": (one(None), one(1.0))}, 0.01).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_leasing_counts_once_in_the_stock(spark, tmp_path):
    import __spark_entry__ as entry

    bonds = "periodo_informacion int, rut_compania long, zip_origen string, source_file string, line_no int, ambito string, tipo_instrumento string, valor_final double, unidad_valor string, valor_texto string, glosa string"
    b = [(202501, 1, "z", "f", 1, "LOCAL", "BE", 100.0, "M$", None, None), (202501, 1, "z", "f", 1, "LOCAL", "BE", 100.0, "M$", None, None), (202501, 1, "z", "f", 2, "LOCAL", "CLEAS", 7.0, "MM$", None, None), (202501, 1, "z", "f", 3, "EXTRANJERO", "BEE", 2.0, "MUSD", None, None)]
    lines = "periodo_informacion int, fecha_descarga date, zip_origen string, source_file string, line_no int, rut_compania long, folio_operacion string, producto string, contraparte_nombre string, moneda string, fecha_vencimiento date, nocional_m double, mtm_activo_m double, mtm_pasivo_m double"
    f = [(202501, D(2025, 2, 1), z, "g", n, 1, "1", p, None, "UF", None, 1.0, a, c) for z, n, p, a, c in [("old", 1, "SWAP", 999.0, 0.0), ("old", 2, "SWAP", 9.0, None), ("old", 3, "PACTO", 50.0, 1.0)]]
    f += [(202501, D(2025, 3, 1), "new", "g", 1, 1, "1", "SWAP", None, "UF", None, 1.0, 30.0, 10.0)]
    for name, rows, schema in (("v_renta_fija_clasificada", b, bonds), ("fact_derivado", f, lines), ("serie_cierre", [("USD", 202501, 950.0)], "serie string, periodo int, valor double")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["clase"], r["fuente"]): r["monto"] for r in entry.queries()["stock_by_class"](spark, str(tmp_path)).collect()}
    assert got == {("Renta Fija", "renta fija local"): 100.0, ("Real Estate", "renta fija local"): 7000.0, ("Renta Fija", "renta fija extranjera"): 1900.0, ("Derivados", "derivados"): 20.0}


def test_fuzzy_resolution_against_all_pairs(spark):
    import random
    from difflib import SequenceMatcher

    r = random.Random(6)
    syl = ["BA", "CO", "DRI", "FE", "GU", "LO", "MON", "TI"]
    word = lambda: "".join(r.choice(syl) for _ in range(r.randint(2, 4)))
    known = sorted({f"INVERSIONES {word()} {word()}" for _ in range(60)})
    typo = lambda s: "".join(c for c in s if r.random() > 0.03)
    names = sorted({typo(r.choice(known)) + r.choice(["", " X"]) for _ in range(150)})
    cat = spark.createDataFrame([(f"e{i:02d}", None, k, None) for i, k in enumerate(known)], "entity string, rut long, alias string, identifier string")
    rows = spark.createDataFrame([(i, None, n, None) for i, n in enumerate(names)], "id int, rut long, name string, identifier string")
    got = {x["id"]: (x["entidad"], x["metodo"]) for x in resolve.cascade(rows, cat, ["id"]).collect()}
    fuzzy = 0
    for i, n in enumerate(names):
        overlap = lambda a, b: len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
        scores = sorted(((-SequenceMatcher(None, n, k).ratio(), f"e{j:02d}") for j, k in enumerate(known) if overlap(n, k) >= resolve.LEAST_OVERLAP))
        if n in known:
            assert got[i] == (f"e{known.index(n):02d}", "alias")
        elif scores and -scores[0][0] >= resolve.LEAST and (len(scores) < 2 or scores[1][0] - scores[0][0] >= resolve.LEAD):
            assert got[i] == (scores[0][1], "fuzzy")
            fuzzy += 1
        else:
            assert got[i][1] == "unresolved"
    assert fuzzy > 20


@pytest.mark.parametrize("limit", [160 << 20, 0])
def test_similar_names_are_all_pairs_that_reach_the_limits(spark, monkeypatch, limit):
    import random
    from difflib import SequenceMatcher

    monkeypatch.setattr(resolve, "INDEX_LIMIT", limit)
    r = random.Random(limit)
    word = lambda: "".join(r.choice("ABCDEILMNORSTU") for _ in range(r.choice([1, 2, 5, 8, 11])))
    rare = [word() for _ in range(80)]
    known = sorted({" ".join(r.choice(["BANCO", "DE", "LA", "S", *rare, *rare[:9]]) for _ in range(r.randint(1, 9))) for _ in range(300)} | {"A", "7 7 7", "AB " * 30 + "AB"})
    edit = lambda s: "".join(x if r.random() > 0.05 else r.choice(["", x + "E", "N", " "]) for x in s)
    names = sorted({n for k in known for n in (" ".join(edit(k).split()), " ".join([*k.split(), "SUR"]), " ".join(reversed(k.split()))) if n})
    ship(spark)
    frames = [spark.createDataFrame([(v,) for v in vs], f"{c} string") for vs, c in ((names, "_name"), (known, "alias"))]
    got = {(x["_name"], x["alias"]): x["_s"] for x in resolve.similar(*frames).collect()}
    want = {}
    for n in names:
        for k in known:
            a, b = set(n.split()), set(k.split())
            if len(a & b) / len(a | b) >= resolve.LEAST_OVERLAP and 2 * min(len(n), len(k)) >= resolve.REACH * (len(n) + len(k)):
                s = SequenceMatcher(None, n, k).ratio()
                if s >= resolve.REACH:
                    want[n, k] = s
    assert got == want and len(want) > 300


def test_a_word_of_every_name_does_not_compare_all_pairs(spark):
    import random
    import time

    r = random.Random(1)
    word = lambda: "".join(r.choice("BCDFGLMNPRT") + r.choice("AEIOU") for _ in range(r.randint(4, 5)))
    known = sorted({f"BANCO DE {word()} {word()}" for _ in range(12000)})
    names = [k[:-2] + k[-1] if i % 10 == 0 else f"BANCO DE {word()} {word()}" for i, k in enumerate(known)]
    cat = spark.createDataFrame([(k, None, k, None) for k in known], "entity string, rut long, alias string, identifier string")
    rows = spark.createDataFrame([(i, None, n, None) for i, n in enumerate(names)], "id int, rut long, name string, identifier string")
    began = time.time()
    got = {x["id"]: x["entidad"] for x in resolve.cascade(rows, cat, ["id"]).where("metodo = 'fuzzy'").collect()}
    assert time.time() - began < 90
    assert all(got.get(i) == known[i] for i in range(0, len(known), 10)) and len(got) == len(range(0, len(known), 10))


def test_exact_steps_are_those_of_the_cascade_without_similarity(spark, monkeypatch):
    cat = spark.createDataFrame([("B2", 97, "Banco de Prueba", "L2"), ("B1", None, "BANCO DE PRUEBA SA", None), ("OTR", 5, "Compania Andina", "L1"), (None, 6, "Sin Entidad", "")], "entity string, rut long, alias string, identifier string")
    rows = spark.createDataFrame([(1, 97, "Compania Andina", "L1"), (2, None, "banco de prueba", "L1"), (3, 8, "zzz", "L1"), (4, None, "Compania Andinas", None), (5, 6, "Sin Entidad", ""), (6, None, None, None), (6, None, "Nadie", "L2")], "id int, rut long, name string, identifier string")
    cols = lambda df: sorted(map(tuple, df.collect()))
    want = {first: cols(resolve.cascade(rows, cat, ["id"], first).where("metodo IN ('rut', 'alias', 'identifier')")) for first in (False, True)}
    monkeypatch.setattr(resolve, "similar", None)
    assert {first: cols(resolve.exact(rows, cat, ["id"], first)) for first in (False, True)} == want
    assert [x[:3] for x in want[False]] == [(1, "B2", "rut"), (2, "B1", "alias"), (3, "OTR", "identifier"), (6, "B2", "identifier")]
    assert [x[:3] for x in want[True]] == [(1, "B2", "rut"), (2, "OTR", "identifier"), (3, "OTR", "identifier"), (6, "B2", "identifier")]


def test_resolve_steps_computes_no_similarity(spark, data, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(resolve, "ratio", None)
    df = entry.queries()["resolve_steps"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" not in plan and "ArrowEvalPython" not in plan and df.count() > 0
