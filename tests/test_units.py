import pytest
from pyspark.sql import functions as F

from lumbra.operators import units

S = "tabla string, periodo_informacion int, zip_origen string, source_file string, line_no int, monto double, unidad_col string, texto string, glosa string, unidad string, _u int"


def _rows(spark, rows):
    return spark.createDataFrame([("t", 202501, "z", f, i, m, u, t, g, "clash", 1) for i, (f, m, u, t, g) in enumerate(rows)], S).drop("unidad", "_u")


def _read(spark, kind, cases):
    df = spark.createDataFrame([(kind, k) for k in cases], "tipo string, _k string").withColumn("grafia", units.folded(F.col("_k")))
    got = {r["grafia"]: r["unidad"] for r in units.alias_dictionary(df.select("tipo", "grafia")).collect()}
    return {r["_k"]: got[r["grafia"]] for r in df.collect()}


def test_spellings_and_typos(spark):
    cases = {
        "MM$": "MMCLP", "mm $": "MMCLP", "M$": "MCLP", "$": "CLP", "US$ Miles": "MUSD", "miles de dolares": "MUSD", "unidades de fometno": "UF", "Millones de  Pesos": "MMCLP", "milones de pesos": "MMCLP",
        "miles de peso": "MCLP", "u.f.": "UF", "bananas": None, "XYZ": None,
    }
    assert _read(spark, "unit", cases) == cases


def test_spellings_that_no_list_holds(spark):
    """Scale and currency are read apart; what contradicts itself, nearly ties or isn't known is reported, not guessed."""
    cases = {
        "thousand UF": "MUF", "billion pesos": "MMMCLP", "miles de millones de pesos": "MMMCLP", "thousands of pesos": "MCLP", "miles de pesos chilenos": "MCLP", "millones de $": "MMCLP", "CLP thousand": "MCLP", "US$ M": "MUSD",
        "Thousands of US dollars": "MUSD", "millones de dólares": "MMUSD", "dólares": "USD", "U$S": "USD", "kCLP": "MCLP", "clpmm": "MMCLP", "tousand pesos": "MCLP", "dollras (thousands)": "MUSD", "unidad de fomento": "UF",
        "mills de pesos": None, "pesos o dólares": None, "miles millones mil": None, "M": None, "euros": None, "miles de euros": None, "-": None,
    }
    assert _read(spark, "unit", cases) == cases


def test_unknown_units_are_reported(spark):
    rows = _rows(spark, [("f", 5.0, "miles de euros", None, "cifra en UF"), ("f", 6.0, "M$", None, None)])
    closes = spark.createDataFrame([("UF", 202501, 38000.0)], "serie string, periodo int, valor double")
    got = {r["line_no"]: (r["unidad"], r["origen_unidad"], r["monto_norma"]) for r in units.in_norm_units(units.with_units(rows), closes).collect()}
    assert got == {0: (None, "unknown", None), 1: ("MCLP", "unit", 6.0)}
    big = _rows(spark, [("f", 2.0, "MMUSD", None, None), ("f", 3.0, "thousand UF", None, None), ("f", 4.0, "billion pesos", None, None)])
    closes = spark.createDataFrame([("UF", 202501, 38000.0), ("USD", 202501, 950.0)], "serie string, periodo int, valor double")
    assert {r["line_no"]: r["monto_norma"] for r in units.in_norm_units(units.with_units(big), closes).collect()} == {0: 1_900_000.0, 1: 114_000.0, 2: 4_000_000.0}


def test_remarks(spark):
    cases = {
        "cobertura de pasivos en UF": "", "importe en US$ miles, sin convertir": "MUSD", "cantidad de UF, no pesos": "UF", "monto informado en pesos, no en miles": "CLP", "comisión de USD 12 pagada al cierre": "",
        "monto en unidades de fomento": "UF", "los montos vienen en MM$": "MMCLP", "valor dado en miles de dólares (ver nota)": "MUSD", "llamar al cliente": "", "monto según mesa " + "muy " * 500 + "revisado en millones de pesos": "MMCLP",
        "amount in thousands": "MCLP", "reported in US dollars (thousands)": "MUSD", "valor sin dividir por mil (pesos)": "CLP", "precio pactado en pesos por dólar": "", "monto en milones de pesos": "MMCLP", "valor en pesos y en dólares": "",
    }
    assert _read(spark, "remark", cases) == cases


@pytest.mark.parametrize(
    ("text", "value", "unit"),
    [
        ("$ 33.828.000", 33828000, "CLP"), ("239,656 millones de pesos", 239.656, "MMCLP"), ("4,938.891 CLP mm", 4938.891, "MMCLP"), ("262.150 CLP mm", 262.15, "MMCLP"), ("USD 3,566.60k", 3566.6, "MUSD"), ("215.735 M$", 215735, "MCLP"),
        ("18.297,55 UF", 18297.55, "UF"), ("CLP 172.801.000.-", 172801000, "CLP"), ("55854000 pesos", 55854000, "CLP"), ("US$ 5.028,54 miles", 5028.54, "MUSD"), ("MM$ 955,581", 955.581, "MMCLP"), ("M$ 704.959", 704959, "MCLP"),
    ],
)
def test_text_amounts(spark, text, value, unit):
    r = units.with_units(_rows(spark, [("f", None, None, text, None)])).first()
    assert r["monto"] == pytest.approx(value) and r["unidad"] == unit


def test_file_as_a_whole(spark):
    norm = [("n", 300_000.0 + i, "M$", None, None) for i in range(20)]
    pesos = [("p", 300_000_000.0 + 1000 * i, None, None, None) for i in range(8)]
    mixed = [("m", 300_000.0 + i, None, None, None) for i in range(7)] + [("m", 300_000_000.0, None, None, None)]
    mill = [("k", 300.123 + i, None, None, None) for i in range(6)] + [("k", 77.0, "M$", None, None)]
    got = units.with_units(_rows(spark, norm + pesos + mixed + mill)).groupBy("source_file", "unidad", "origen_unidad").count().collect()
    assert {(r["source_file"], r["unidad"], r["origen_unidad"]): r["count"] for r in got} == {("n", "MCLP", "unit"): 20, ("p", "CLP", "file"): 8, ("m", "MCLP", "norm"): 8, ("k", "MMCLP", "file"): 6, ("k", "MCLP", "unit"): 1}


def test_conversion_and_edges(spark):
    rows = _rows(spark, [("f", 1000.0, "CLP", None, None), ("f", 2.0, "MM$", None, None), ("f", 3.0, "MUSD", None, None), ("f", 4.0, "UF", None, None), ("f", None, "UF", None, None), ("f", None, None, "s/i", None), ("f", float("nan"), "UF", None, None), ("f", 0.0, "", " ", "x" * 100_000)])
    closes = spark.createDataFrame([("UF", 202501, 38000.0), ("USD", 202501, 950.0)], "serie string, periodo int, valor double")
    got = {r["line_no"]: r["monto_norma"] for r in units.in_norm_units(units.with_units(rows), closes).collect()}
    assert got == {0: 1.0, 1: 2000.0, 2: 2850.0, 3: 152.0, 7: 0.0}
    assert units.with_units(rows.limit(0)).count() == 0
    other = units.in_norm_units(units.with_units(rows), closes.where(F.col("serie") == "XX"))
    assert other.where("monto_norma IS NULL").count() == 2
