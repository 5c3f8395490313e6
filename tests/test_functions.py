import datetime as dt

import pytest
from pyspark.sql import functions as F

from lumbra.functions import dates, identifiers, labels, numbers, text


def _one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("chunk", "width", "dec", "signed", "want"),
    [("0012", 4, 0, False, 12), ("1,5", 3, 0, False, 105), ("-007", 4, 0, True, -7), ("+007", 4, 0, True, 7), (" 007", 4, 0, True, 7), ("1007", 4, 0, True, 1007), ("+00000000012", 12, 0, False, None), ("    ", 4, 0, False, 0), ("    ", 4, 0, True, 0), ("1x", 2, 0, False, None)],
)
def test_filed_number(spark, chunk, width, dec, signed, want):
    assert _one(spark, numbers.filed_number(F.lit(chunk), width, dec, signed)) == want


def test_implied_decimals_and_dates(spark):
    assert float(_one(spark, numbers.filed_number(F.lit("00000000000123456"), 17, 4))) == 12.3456
    assert [_one(spark, dates.filed_date(F.lit(x))) for x in ("20260831", "00000000", "20261399", "        ")] == [dt.date(2026, 8, 31), None, None, None]
    assert [_one(spark, dates.period_token(F.lit(x))) for x in ("231231", "202501", "202412", "999999", "2025")] == [202312, 202501, 202412, None, None]
    assert _one(spark, dates.months_back(F.lit(202601))) == 202512 and _one(spark, dates.months_back(F.lit(202601), 14)) == 202411
    assert _one(spark, dates.century_fixed(F.lit(dt.date(1926, 1, 5)), F.lit(dt.date(2020, 1, 1)))) == dt.date(2026, 1, 5)


def test_identifiers(spark):
    assert [_one(spark, identifiers.mod11_valid(F.lit(97006000), F.lit(d))) for d in ("6", "1", None)] == [True, False, False]
    assert _one(spark, identifiers.mod11_digit(F.lit(0))) is None
    assert _one(spark, identifiers.lei_valid(F.lit("5493001KJTIIGC8Y1R12"))) is True and _one(spark, identifiers.lei_valid(F.lit("5493001KJTIIGC8Y1R13"))) is False


def test_names(spark):
    names = {"Banco de Chile S.A.": "BANCO DE", "K AMERICA 076123456 JP MORGAN CHASE N.A.": "K AMERICA JP MORGAN CHASE", None: "", "": "", "CHILE": "CHILE", "Agüero & Cía Ltda.": "AGUERO"}
    assert {k: _one(spark, text.name_key(F.lit(k).cast("string"))) for k in names} == names
    assert _one(spark, text.acronym(F.lit("Banco Bilbao Vizcaya Argentaria S.A."))) == "BBVA"
    assert _one(spark, text.same_name(F.lit("BBVA ESPANA"), F.lit("Banco Bilbao Vizcaya Argentaria"))) is True
    assert _one(spark, text.same_name(F.lit("JPMORGAN"), F.lit("J P Morgan Chase"))) is True
    assert _one(spark, text.same_name(F.lit("Uno Dos"), F.lit("Nadie"))) is False
    assert _one(spark, text.clean(F.lit("\t \n"))) is None


def test_rates(spark):
    assert [(_one(spark, numbers.rate_value(F.lit(x))), _one(spark, numbers.rate_label(F.lit(x)))) for x in ("FIJA 5.11", "VARIABLE 3,2", "SOFR", "4")] == [(5.11, "FIJA"), (3.2, "VARIABLE"), (None, "SOFR"), (4.0, None)]
    assert [_one(spark, numbers.is_fixed(F.lit(x).cast("string"))) for x in ("FIJA", "SOFRC", "X", None)] == [True, False, None, None]
    assert round(_one(spark, numbers.breakeven(F.lit(0.0), F.lit(2.99))), 6) == 2.99 and _one(spark, numbers.breakeven(F.lit(0.0), F.lit(0.0))) is None
    assert float(_one(spark, numbers.spanish_amount(F.lit("$ 39.643,59")))) == 39643.59
    assert _one(spark, numbers.least_positive(F.lit(0.0), F.lit(5.0), F.lit(9.0))) == 5.0


def test_decimals_and_first_rates(spark):
    df = spark.createDataFrame([(1.5, "2", True, dt.date(2025, 1, 1), "s/i", "SOFR 4,5", None), (float("nan"), "2", None, None, None, "", "FIJA 3")], "a double, b string, c boolean, d date, x string, y string, z string")
    got = df.select(*[numbers.decimal_only(df, c).cast("double").alias(c) for c in "abcd"], numbers.first_rate(["x", "y", "z"]).alias("r")).collect()
    assert [tuple(r)[:4] for r in got] == [(1.5, None, None, None), (None, None, None, None)]
    assert [tuple(r["r"]) for r in got] == [(4.5, "SOFR", "y"), (3.0, "FIJA", "z")]


def test_labels(spark):
    assert [_one(spark, labels.band(F.lit(x).cast("double"), labels.MATURITY)) for x in (-1, 0, 0.25, 12, None)] == ["vencido", "0-3m", "3-12m", "10a+", None]
    assert [_one(spark, labels.band(F.lit(x), labels.ORIGINAL, "right")) for x in (31, 32, 9000)] == ["Hasta 1M", "1-3M", "Más de 20A"]
    assert _one(spark, labels.prefix_class(F.lit("CFIX"), {"CF": "a", "CFI": "b"}, "z")) == "b"
    assert [_one(spark, text.currency(F.lit(x))) for x in (" prom", "$$", "", "uf ")] == ["USD", "CLP", None, "UF"]
    assert _one(spark, text.month_label(F.lit(202608))) == "ago-26" and _one(spark, text.month_title(F.lit(202608))) == "Ago-2026"
    assert _one(spark, text.pair(F.lit("CLP"), F.lit("UF"))) == "UF/CLP" and _one(spark, text.pair(F.lit("ZZZ"), F.lit("AAA"))) == "AAA/ZZZ"
