import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbra.llm import encoding as E

WORDS = ["Compañía", "Güelosá", "Crédito", "Ñandú", "BANCO LIÉCORBÉTO", "São Participações", "Conceição", "Verónica", "Pingüino Ñoñó", "RÚNTORARÚN", "Dorliékevó"]


@pytest.mark.parametrize("wrong", E.WRONG)
@pytest.mark.parametrize("times", [1, 2, 3])
def test_round_trip_of_utf8(wrong, times):
    for w in WORDS:
        g = w
        for _ in range(times):
            g = E._misread(g, wrong)
            if g is None:
                break
        if g is not None and g != w:
            assert E.repair(g) == (True, w, True), (w, g)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(WORDS), min_size=1, max_size=4), st.integers(0, 3), st.sampled_from(["latin_1", "cp1252", "mac_roman", "cp850", "cp437"]))
def test_only_spans_change(words, k, wrong):
    k = min(k, len(words) - 1)
    mixed = " ".join(E._misread(w, wrong) if i == k else w for i, w in enumerate(words))
    assert E.repair(mixed)[1] == " ".join(words)


@pytest.mark.parametrize(
    ("garbled", "right"),
    [("COMPA—ÕA DE SEGUROS", "COMPAÑÍA DE SEGUROS"), ("Mercedes G¾rafuros R·n±ipledu", "Mercedes Górafuros Rúnñipledu"), ("Beatriz Grikepune Nev¾bÚo", "Beatriz Grikepune Nevóbéo"), ("NELI╔XABA", "NELIÉXABA"), ("Roberto Balurendrß", "Roberto Balurendrá"), ("Sebastißn Huetidumon", "Sebastián Huetidumon"), ("CONCEI«√O Seguradora", "CONCEIÇÃO Seguradora"), ("Muсoz y Peсa", "Muñoz y Peña"), ("JES⁄S —IDORTILI… V”JILUVA", "JESÚS ÑIDORTILIÉ VÓJILUVA")],
)
def test_single_byte_pairs(garbled, right):
    assert E.repair(garbled) == (True, right, True)


@pytest.mark.parametrize("text", ["", "plain", "Großhandel Kredit", "IRMÃOS CORRETORA", "São Participações S.A.", "Mª José", "Crédit Fédéral", "Conceição", "Café — y té", "N.º 5", "PARTICIPAÇÕES", "L’Été “uno”", "Compañia sin acento", "Łódź", "東京"])
def test_right_text_stays(text):
    assert E.repair(text) == (False, text, True)


def test_beyond_repair_cut_and_long():
    assert E.repair("In�s")[0] and not E.repair("In�s")[2]
    cut = "ADMINISTRADORA GENERAL DE FONDOS PELTATANI CORLIÃ‰VENLIÃ"
    assert E.repair(cut)[0] and "CORLIÉVENLI" in E.repair(cut)[1]
    long = "CompaÃ±Ã\xada " * 20_000
    assert E.repair(long)[1] == "Compañía " * 20_000


def test_tables(spark):
    n = spark.createDataFrame([(1, "CrÃ©dito", "x"), (1, "CrÃ©dito", "x"), (2, None, "x"), (3, "Crédito", "x")], "registro_id long, nombre string, texto string")
    p = spark.createDataFrame([("RUT 1", "SÃ£o"), (None, "SÃ£o")], "entidad_id string, entidad_nombre string")
    got = {(r["tabla"], r["clave"], r["reparado"]) for r in E.garbled_names(n, p).collect()}
    assert got == {("cmf_v2024", "1", "Crédito"), ("contrapartes", "RUT 1", "São"), ("contrapartes", None, "São")}
    assert E.garbled_names(n.limit(0), p.limit(0)).count() == 0
