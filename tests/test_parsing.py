import csv
import io

import pytest

from lumbra.operators import parsing

S = "periodo_informacion int, fecha_descarga date, zip_origen string, source_file string, line_no int, rut_compania long, formato string, raw string, _why string"
GOOD2 = "2RFI" + "0," + "0" * 10 + "+" + "0" * 11 + " " * 12 + ("-" + "0" * 13) * 6 + "1" * 14
GOOD1 = "1" + "093819495" + "K" + "X" * 60 + "2,2512" + " " * 61
LEI = "ZZ99NCN8A6N92UG63B15"


def _why(spark, rows):
    df = spark.createDataFrame([(202501, None, "z", "f", i, 1, k, r, "clash") for i, (k, r) in enumerate(rows)], S)
    return {r["line_no"]: r["_motivo"] for r in parsing.split_rows(df).collect()}


def test_fixed_width(spark):
    assert len(GOOD1) == len(GOOD2) == 138
    bad = [GOOD2[:-1], GOOD2 + " ", "7" + GOOD2[1:], GOOD2[:16] + "0" * 11 + "-" + GOOD2[28:], GOOD1[:75] + "13" + GOOD1[77:], "3  0001" + " " * 131, GOOD2[:4] + "+" + GOOD2[5:]]
    got = _why(spark, [("C", x) for x in [GOOD1, GOOD2, "3000001" + " " * 131, "", "  ", "# x", None, *bad]])
    assert {k: v for k, v in got.items() if v is None}.keys() == {0, 1, 2}
    names = ["length", "length", "record code", "MONTO_1", "PERIODO", "TOTAL_REGISTROS", "VALOR_FINAL"]
    assert [got[7 + i].split(":")[0] for i in range(len(bad))] == names


@pytest.mark.parametrize(
    ("raw", "why"),
    [
        (f'{LEI},ISSUED,"A ""B"" C, S.A.",CL,,', None), (f'"{LEI}",PENDING,X,"ES","FUND","ACTIVE"', None), (f"{LEI},ISSUED,,CL,,", None), (f"{LEI},ISSUED,A # 2,CL,BRANCH,INACTIVE", None),
        (f"{LEI};ISSUED;X;CL;;", "columns: 1"), (f"{LEI},ISSUED,A, S.A.,CL,,", "columns: 7"), (f'{LEI},ISSUED,"A" SA,CL,,', "quoting"), (f'{LEI},ISSUED,"A,CL,,', "quoting"), (f'{LEI},ISSUED,A"B,CL,,', "quoting"),
        (f"{LEI[:-1]},ISSUED,X,CL,,", "lei"), (f"{LEI},issued,X,CL,,", "estado_lei"), (f"{LEI},ISSUED,X,cl,,", "pais"), (f"{LEI},ISSUED,X,CL,general,", "categoria"), (f"{LEI},ISSUED,X,CL,,SI", "estado_entidad"), (f"{LEI},ISSUED,X,CL", "columns: 4"),
    ],
)
def test_delimited(spark, raw, why):
    assert _why(spark, [("L", raw)]) == {0: why}


def test_unknown_format_header_and_long_rows(spark):
    got = _why(spark, [("Q", "x"), (None, "x"), ("L", parsing.HEADER), ("L", parsing.HEADER.upper()), ("L", "a" * 300_000), ("C", "2" * 300_000), ("L", '"' * 50_001)])
    assert got == {0: "format: Q", 1: "format: null", 4: "columns: 1", 5: "length: 300000", 6: "quoting"}


def test_rejected_once_and_loaded_values(spark):
    df = spark.createDataFrame([(202501, None, "z", "f", i, 1, "L", f'{LEI},ISSUED,"A ""B"", C",CL,,ACTIVE', "") for i in (1, 1)] + [(202501, None, "z", "f", 3, 1, "C", "bad", "")] * 2, S)
    assert parsing.rejected(df).count() == 1
    row = parsing.loaded_names(df).collect()
    assert len(row) == 1
    assert list(row[0])[3:] == [next(csv.reader(io.StringIO(f'{LEI},ISSUED,"A ""B"", C",CL,,ACTIVE')))[i] or None for i in range(6)]
    assert parsing.rejected(df.limit(0)).count() == 0


def test_loaded_amounts(spark):
    df = spark.createDataFrame([(202501, None, "z", "f", 1, 1, "C", GOOD2, "")], S)
    r = parsing.loaded_control(df).first()
    assert (r["tipo_inversion"], r["valor_final"], r["monto_1"], r["monto_2"], r["monto_9"]) == ("RFI", 0, 0, 0, 11111111111111)
