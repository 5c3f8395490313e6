import datetime as dt
import random

from pyspark.sql import functions as F

from lumbra.operators import asof

EV = "evento_id long, ts timestamp, rut_compania long, folio_operacion string, item_operacion string, _bucket int, zip_origen string"
LI = "periodo_informacion int, fecha_descarga date, zip_origen string, source_file string, line_no int, rut_compania long, folio_operacion string, item_operacion string, ts string"


def _brute(events, lines):
    out = {}
    for e in set(events):
        best = None
        for x in lines:
            p, seen, z, f, n = x[0], x[1], x[2], x[3], x[4]
            if None in (seen, e[1], e[3]) or (x[5], x[6], x[7]) != (e[2], e[3], e[4]):
                continue
            y, m = divmod(p, 100)
            close = (dt.date(y + m // 12, m % 12 + 1, 1)) - dt.timedelta(days=1)
            if seen <= e[1].date() and close <= e[1].date():
                best = max(best or (0,), (p, seen, z, f, n))
        if best and len(best) > 1:
            out[e[0]] = best[2:]
    return out


def _case(n_events, n_lines, seed):
    r = random.Random(seed)
    folio = lambda: r.choice(["A", "A", "A", "B", "C", None])
    ev = [(i, None if r.random() < 0.05 else dt.datetime(2025, 1, 1) + dt.timedelta(days=r.randrange(400), seconds=r.randrange(86400)), r.choice([1, 2]), folio(), "001", 9, "x") for i in range(n_events)]
    li = [(202400 + r.randint(1, 12) if r.random() < 0.5 else 202500 + r.randint(1, 12), None if r.random() < 0.1 else dt.date(2025, 1, 1) + dt.timedelta(days=r.randrange(400)), f"z{i % 7}", "f", i, r.choice([1, 2]), folio(), "001", "clash") for i in range(n_lines)]
    return ev + ev[:5], li + li[:5]


def test_against_brute_force_with_hot_entities(spark):
    ev, li = _case(150, 120, 1)
    e, v = spark.createDataFrame(ev, EV), spark.createDataFrame(li, LI)
    want = _brute(ev, li)
    for hot in (200_000, 3):
        got = {r["evento_id"]: (r["zip_origen"], r["source_file"], r["line_no"]) for r in asof.desk_event_lines(e, v, hot_events=hot).collect()}
        assert got == want


def test_one_row_an_event_and_empty_tables(spark):
    ev, li = _case(40, 40, 2)
    e, v = spark.createDataFrame(ev, EV), spark.createDataFrame(li, LI)
    got = asof.desk_event_lines(e, v)
    assert got.count() == got.select("evento_id").distinct().count()
    assert asof.desk_event_lines(e.limit(0), v).count() == 0
    assert asof.desk_event_lines(e, v.limit(0)).count() == 0
    assert asof.desk_event_lines(e.withColumn("folio_operacion", F.lit(None).cast("string")), v).count() == 0


def test_a_later_download_of_an_older_period_does_not_win(spark):
    d = dt.date
    li = [(202501, d(2025, 2, 10), "a", "f", 1, 1, "A", "001", ""), (202502, d(2025, 3, 10), "b", "f", 1, 1, "A", "001", ""), (202501, d(2025, 4, 1), "c", "f", 1, 1, "A", "001", "")]
    ev = [(i, dt.datetime(2025, m, day), 1, "A", "001", 0, "") for i, (m, day) in enumerate([(2, 9), (2, 10), (3, 9), (3, 10), (4, 2)])]
    got = {r["evento_id"]: r["zip_origen"] for r in asof.desk_event_lines(spark.createDataFrame(ev, EV), spark.createDataFrame(li, LI)).collect()}
    assert got == {1: "a", 2: "a", 3: "b", 4: "b"}
