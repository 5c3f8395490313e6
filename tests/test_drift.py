import datetime as dt

from pyspark.sql import functions as F

from lumbra.operators import drift

CF = "archivo_id long, serie_id long, letra string, periodo int, fecha_descarga date, pos int, campo string, pic string, _f string"
LN = "archivo_id long, line_no int, raw string, campo string"


def _files(spark, files, lines):
    rows = [(a, s, "G", p, d, i, n, pic, "x") for a, s, p, d, fs in files for i, (n, pic) in enumerate(fs, 1)]
    rows += rows[:3]
    return spark.createDataFrame(rows, CF), spark.createDataFrame([(a, n, r, "x") for a, n, r in lines + lines[:1]], LN)


BASE = [("Folio Operación", "9(04)"), ("MONEDA", "X(3)"), ("TASA", "-9(2)V9(02)")]


def test_all_kinds_of_change(spark):
    d = dt.date
    files = [
        (1, 1, 202501, d(2025, 2, 1), BASE),
        (2, 1, 202502, d(2025, 3, 1), [("X", "9(9)")]),  # replaced by a later download
        (3, 1, 202502, d(2025, 3, 9), [("folio-operacion", "9999"), ("tasa", "-99V99"), ("DIVISA", "X(03)"), ("NUEVO", "X(1)")]),
        (4, 1, 202504, None, [("FOLIO_OPERACION", "9(06)"), ("TASA", "9(2)V9(2)"), ("DIVISA", "9(3)")]),
        (5, 2, 202501, d(2025, 2, 1), BASE),
    ]
    lines = [(1, 1, "0001CLP+0150"), (1, 2, "0002USD-0150"), (3, 1, "0001+0150CLPa"), (3, 2, "0002-0150USDb"), (4, 1, "0000010150001"), (2, 1, "000000000")]
    f, ln = _files(spark, files, lines)
    got = {(r["archivo_id"], r["campo"], r["cambio"]) for r in drift.schema_changes(f, ln).collect()}
    assert got == {(3, "DIVISA", "renamed"), (3, "NUEVO", "added"), (4, "NUEVO", "removed"), (4, "FOLIO_OPERACION", "resized"), (4, "TASA", "retyped"), (4, "DIVISA", "retyped")}


def test_other_values_or_no_lines_are_no_rename(spark):
    d = dt.date
    files = [(1, 1, 202501, d(2025, 2, 1), [("A", "X(3)")]), (2, 1, 202502, d(2025, 3, 1), [("B", "X(3)")])]
    for lines in ([(1, 1, "abc"), (2, 1, "xyz")], [(9, 1, "abc")]):
        f, ln = _files(spark, files, lines)
        assert {(r["campo"], r["cambio"]) for r in drift.schema_changes(f, ln).collect()} == {("A", "removed"), ("B", "added")}
    f, ln = _files(spark, files, [(1, 1, "abc")])
    assert drift.schema_changes(f.limit(0), ln.limit(0)).count() == 0


def test_one_table(spark):
    d = dt.date
    files = [(1, 1, 202501, d(2025, 2, 1), [("FECHA", "9(08)"), ("MONTO", "9(3)V99"), ("NOMBRE", "X(4)")]), (2, 1, 202502, d(2025, 3, 1), [("RAZON", "X(4)"), ("FECHA", "X(10)"), ("MONTO", "9(5)")])]
    lines = [(1, 1, "20250131" + "00150" + "ab  "), (1, 2, "20250231" + "00x50" + "cd"), (2, 1, "ab  2025-01-3100007"), (2, 2, "cd  2025-02-2800008")]
    f, ln = _files(spark, files, lines)
    rows = {(r["archivo_id"], r["line_no"]): r for r in drift.one_table(f, ln).collect()}
    assert len(rows) == 4
    assert drift.aliases(drift.schema_changes(f, ln), drift.field_lists(f)) == ({("G", "NOMBRE"): "NOMBRE", ("G", "RAZON"): "NOMBRE"}, [])
    assert rows[1, 1]["nombre"] == rows[2, 1]["nombre"] == "ab"
    types = {(r["archivo_id"], r["campo"], r["tipo"]): r["filas"] for r in drift.path_types(drift.path_values(ln, drift.field_lists(f))).collect()}
    assert rows[1, 2]["_fallidos"] == ["FECHA"] and rows[1, 1]["_fallidos"] == []
    assert types[1, "FECHA", "date8"] == 2 and types[2, "FECHA", "iso"] == 2 and types[1, "MONTO", "text"] == 1


def test_names_that_one_file_has_together_stay_apart(spark):
    """A renamed to B in one series; a file of another has both, and keeps both values."""
    d = dt.date
    files = [(1, 1, 202501, d(2025, 2, 1), [("A", "X(3)")]), (2, 1, 202502, d(2025, 3, 1), [("B", "X(3)")]), (3, 2, 202501, d(2025, 2, 1), [("A", "X(3)"), ("B", "X(3)"), ("PERIODO", "9(6)")])]
    f, ln = _files(spark, files, [(1, 1, "xyz"), (2, 1, "xyz"), (3, 1, "aaabbb202501")])
    changes = drift.schema_changes(f, ln)
    assert [(r["campo"], r["campo_antes"], r["cambio"]) for r in changes.collect()] == [("B", "A", "renamed")]
    known, refused = drift.aliases(changes, drift.field_lists(f))
    assert refused == [("G", "B", "A")] and known == {("G", "A"): "A", ("G", "B"): "B"}
    rows = {r["archivo_id"]: (r["a"], r["b"], r["_fallidos"]) for r in drift.one_table(f, ln).collect()}
    assert rows == {1: ("xyz", None, []), 2: (None, "xyz", []), 3: ("aaa", "bbb", [])}
    other = f.withColumn("letra", F.when(F.col("serie_id") == 1, "G").otherwise("P"))
    rows = {r["archivo_id"]: (r["a"], r["b"], r["periodo"], r["campo_periodo"]) for r in drift.one_table(other, ln).collect()}
    assert rows == {1: ("xyz", None, 202501, None), 2: ("xyz", None, 202502, None), 3: ("aaa", "bbb", 202501, 202501)}


def test_blank_fields_are_no_rename(spark):
    d = dt.date
    files = [(1, 1, 202501, d(2025, 2, 1), [("K", "9(1)"), ("A", "X(3)")]), (2, 1, 202502, d(2025, 3, 1), [("K", "9(1)"), ("B", "X(3)")])]
    f, ln = _files(spark, files, [(1, 1, "1   "), (2, 1, "1   "), (1, 2, "2"), (2, 2, "2")])
    got = {(r["campo"], r["cambio"], r["tipos_antes"], r["tipos"]) for r in drift.schema_changes(f, ln).collect()}
    assert got == {("A", "removed", "empty", None), ("B", "added", None, "empty")}


def test_many_renames_of_one_picture(spark):
    """Twelve fields change their names at once; each keeps its values, two of them but for every third line."""
    d = dt.date
    old, new = [(f"V{i}", "X(2)") for i in range(12)], [(f"N{i}", "X(2)") for i in reversed(range(12))]
    value = lambda i, n, month: f"{chr(97 + i)}{'z' if i < 2 and month and n % 3 == 0 else n}"
    lines = [(1, n, "".join(value(i, n, 0) for i in range(12))) for n in range(9)] + [(2, n, "".join(value(i, n, 1) for i in reversed(range(12)))) for n in range(9)]
    f, ln = _files(spark, [(1, 1, 202501, d(2025, 2, 1), old), (2, 1, 202502, d(2025, 3, 1), new)], lines)
    assert {(r["campo"], r["campo_antes"], r["cambio"]) for r in drift.schema_changes(f, ln).collect()} == {(f"N{i}", f"V{i}", "renamed") for i in range(12)}


def test_pictures(spark):
    pics = ["9(13)V9(04)", "-9999V9(3)", "999", "X(02)", "xx", " 9(3) V99", "", None]
    df = spark.createDataFrame([(1, 1, "G", 202501, None, i, f"c{i}", p, "") for i, p in enumerate(pics)], CF)
    got = {r["campo"]: (r["kind"], r["signed"], r["decimals"], r["width"]) for r in drift.field_lists(df).collect()}
    assert [got[f"C{i}"] for i in range(8)] == [("9", False, 4, 17), ("9", True, 3, 8), ("9", False, 0, 3), ("X", False, 0, 2), ("X", False, 0, 2), ("9", False, 2, 5), ("X", False, 0, 0), ("X", False, 0, 0)]
