import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lumbra.sources import files, layout, zipped
from lumbra.streaming import landing

SPEC = {"C": {"length": 20, "records": {"1": [{"name": "NOMBRE", "start": 1, "picture": "X(05)", "len": 5}], "2": [{"name": "CLAVE", "start": 1, "picture": "9(04)", "kind": "num"}, {"name": "TASA", "start": 5, "picture": "-9(2)V9(2)", "kind": "num"}, {"name": "FECHA", "start": 10, "picture": "9(08)", "kind": "date"}]}}}


def test_zip_members_encodings_and_lines(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    with zipfile.ZipFile(tmp_path / "sub" / "a.zip", "w") as z:
        z.writestr("i202608v.96573600", "1ÑANDÚ              \n\n2x\u0085y".encode())
        z.writestr("p231231.777777", "1ÑU\r\n2\n".encode("cp1252"))
        z.writestr("readme.txt", "no")
        z.writestr("i202608x.96573600", "2")
        z.writestr("i202608v.777", "2")
    spark.dataSource.register(zipped.ZippedLines)
    read = lambda **o: spark.read.format("zipped_lines").options(**o).load(str(tmp_path))
    rows = {(r["source_file"], r["line_no"]): r for r in read().collect()}
    assert rows.keys() == {("i202608v.96573600", 1), ("i202608v.96573600", 3), ("p231231.777777", 1), ("p231231.777777", 2)}
    assert rows["i202608v.96573600", 1]["raw"].startswith("1ÑANDÚ") and rows["p231231.777777", 1]["raw"] == "1ÑU"
    assert rows["p231231.777777", 2]["periodo"] == 202312 and rows["i202608v.96573600", 3]["raw"] == "2x\u0085y"
    assert set(zipped.archives(spark, str(tmp_path)).collect()) == set(rows.values())
    assert zipped.archives(spark, str(tmp_path), "p", 202312, batch=1).count() == 2 and zipped.archives(spark, str(tmp_path), "", 202501).count() == 0
    assert read(letters="P").count() == 2 and read(period="202608").count() == 2 and read(letters="Z").count() == 0


def test_layout(spark):
    lo = layout.load(SPEC)["C"]
    assert lo.gaps("1") == [(6, 20)]
    lines = spark.createDataFrame([("1ÑANDÚ" + " " * 14, 1), ("20,12-015020260831  ", 2), ("20012x015000000000  ", 3), ("2short", 4), ("9" + " " * 19, 5), ("2" + " " * 19, 6)], "raw string, line_no int")
    got = {r["line_no"]: r for r in lo.parsed(lines, "2").collect()}
    assert (got[2]["CLAVE"], float(got[2]["TASA"]), str(got[2]["FECHA"]), got[2]["_bad"]) == (12, -1.5, "2026-08-31", [])
    assert got[3]["_bad"] == ["TASA"] and got[3]["FECHA"] is None and got[6]["CLAVE"] == 0
    fact = lo.facts(lines, "2", {"CLAVE": "id", "TASA": "tasa", "OTRO": "otro"}, {"doble": F.col("tasa") * 2, "signo": F.signum("doble")})
    assert fact.columns == ["line_no", "id", "tasa", "otro", "_bad", "doble", "signo"] and {r["line_no"]: r["signo"] for r in fact.collect()}[2] == -1
    assert lo.parsed(lines, "1").first()["NOMBRE"] == "ÑANDÚ"
    assert {r["line_no"]: r["_why"] for r in lo.strays(lines).collect()} == {4: "length 6", 5: "code 9"}
    assert layout.coverage(spark, {"C": lo}).agg(F.sum("campos")).first()[0] == 4


@pytest.mark.parametrize("change", [{"start": 3}, {"len": 9}, {"picture": "9(x)"}, {"start": 19}])
def test_layout_errors(change):
    spec = json.loads(json.dumps(SPEC))
    spec["C"]["records"]["2"][1].update(change)
    with pytest.raises(ValueError):
        layout.load(spec)


def test_writes_replace_only_their_partition(spark, tmp_path):
    p = str(tmp_path / "fact")
    df = spark.createDataFrame([(202501, "a", "I", 1), (202501, "b", "I", 2), (202502, "c", "P", 3)], "periodo_informacion int, zip_origen string, letra string, v int")
    files.write_fact(df, p)
    files.write_fact(df.where("zip_origen = 'b'").withColumn("v", F.lit(9)).withColumn("nuevo", F.lit("x")), p)
    files.write_fact(df.withColumn("v", F.lit(7)), p, letters=["P"])
    got = lambda: {(r["zip_origen"], r["letra"]): (r["v"], r["nuevo"]) for r in files.warehouse(spark, p).collect()}
    assert got() == {("a", "I"): (1, None), ("b", "I"): (9, "x"), ("c", "P"): (7, None)}
    files.write_fact(df.withColumn("letra", F.lit("P")), p, letters=["P"])
    assert got() == {("a", "I"): (1, None), ("a", "P"): (1, None), ("b", "I"): (9, "x"), ("b", "P"): (2, None), ("c", "P"): (3, None)}
    files.write_fact(df, p)
    files.write_fact(df.limit(0), p, letters=["P"])
    assert {(r["zip_origen"], r["letra"]) for r in files.warehouse(spark, p).collect()} == {("a", "I"), ("b", "I"), ("c", "P")}
    zeros = spark.createDataFrame([(202501, "0012", "I", 1)], "periodo_informacion int, zip_origen string, letra string, v int")
    files.write_fact(zeros, str(tmp_path / "first"), letters=["I"])
    assert files.warehouse(spark, str(tmp_path / "first")).first()["zip_origen"] == "0012"
    files.portable({"f": files.warehouse(spark, p)}, {"d": df}, str(tmp_path / "out"), 1)
    assert spark.read.parquet(str(tmp_path / "out/f")).count() == 1 and spark.read.parquet(str(tmp_path / "out/d")).count() == 3


def test_small_formats(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"cierres": {"202312": {"fecha": "2023-12-29", "valor": 884.59}}, "dias": {"2023-12-28": 880.0, "2023-12-29": 884.59}}))
    closes, days = files.series_json(spark, str(tmp_path / "s.json"))
    assert tuple(closes.first())[0::2] == (202312, 884.59) and days.count() == 2
    (tmp_path / "l.csv").write_text('# note\nlei,nombre\nA,"x ""y"", z"\n')
    assert tuple(files.commented_csv(spark, str(tmp_path / "l.csv")).first()) == ("A", 'x "y", z')
    files.write_csv(spark.createDataFrame([("A", 'x "y", z')], "lei string, nombre string"), str(tmp_path / "out"))
    assert tuple(files.commented_csv(spark, str(tmp_path / "out")).first()) == ("A", 'x "y", z')
    cat = files.catalog(spark, [{"key": "A", "name": "Uno", "ruts": [5], "parent": "B", "identifiers": [" lei "]}])
    assert {(r["rut"], r["alias"], r["identifier"], r["parent"]) for r in cat.collect()} == {(5, None, None, None), (None, "Uno", None, None), (None, None, "LEI", None)}


def test_streaming_ingest(spark, tmp_path, data):
    raw = spark.read.parquet(f"{data}/parsed_record.parquet")
    raw.write.parquet(str(tmp_path / "in"))
    run = lambda: landing.ingest(spark, str(tmp_path / "in"), raw.schema, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    run()
    n = spark.read.parquet(str(tmp_path / "ok")).count(), spark.read.parquet(str(tmp_path / "bad")).count()
    run()
    assert n == (spark.read.parquet(str(tmp_path / "ok")).count(), spark.read.parquet(str(tmp_path / "bad")).count()) and min(n) > 0


def test_files_that_land_in_parts_and_again(spark, tmp_path):
    schema = "periodo_informacion int, fecha_descarga date, zip_origen string, source_file string, line_no int, rut_compania long, formato string, raw string"
    good, bad = "3000012".ljust(138), "3x"
    rows = lambda day, *ls, f="a": [(202501, dt.date(2025, 2, day), "z.zip", f, n, 1, "C", raw) for n, raw in ls]

    def land(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        landing.ingest(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
        return [sorted((r["source_file"], r["line_no"]) for r in files.warehouse(spark, str(tmp_path / p)).collect()) if files._exists(spark, str(tmp_path / p)) else [] for p in ("ok", "bad")]

    assert land("1", rows(1, (1, good), (2, bad))) == [[("a", 1)], [("a", 2)]]
    assert land("2", rows(1, (3, good)) + rows(1, (1, bad), f="b")) == [[("a", 1), ("a", 3)], [("a", 2), ("b", 1)]]
    assert land("3", rows(9, (1, good), (2, good)) + rows(1, (1, good), f="b")) == [[("a", 1), ("a", 2), ("b", 1)], []]
    assert land("4", rows(3, (7, good))) == [[("a", 1), ("a", 2), ("b", 1)], []]


def test_sessions(spark, data):
    e = spark.read.parquet(f"{data}/evento_mesa.parquet")
    assert landing.sessions(e).agg(F.sum("n")).first()[0] == e.where("ts IS NOT NULL").count()
