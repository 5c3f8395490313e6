import itertools
import random

import pytest

from lumbra.llm import names as N

SAME = [
    ["Banco Kemaferple Tapelquehue N.A.", "bco kemaferple tapelquehue", "BANCO KEMAFERPLE TAPELQUHUE", "Kemaferple Tapelquehue, Banco", "Banco Kemaferple T. Suc. Norte", "912345678 BNCO. KEMAFERPLE TAPELQUEHUE SA"],
    ["Corredores de Bolsa Dorliékevó Monbévendrá", "CdB Dorliékevó Monbévendrá Ltda.", "C. de B. Dorliékevó-Monbévendrá", "CORREDORES DE BOLSA DORLIÃ‰KEVÃ“ MONBÃ‰VENDRÃ\x81"],
    ["Graciela Ketobavó Talupledrá", "Chela Ketobavó Talupledrá", "KETOBAVÓ TALUPLEDRÁ, CHELA", "Sra. Graciela María Ketobavó Talupledrá", "G. Ketobavó Talupledrá", "Ketobavó T., Graciela"],
    ["Inversiones Kemaferple Tapelquehue"],
    ["Roberto Ketobavó Talupledrá", "Tito Ketobavo Talupledra"],
    ["Agencia de Valores Kemaferple Tapelquehue AG", "AV Kemaferple Tapelquehue"],
]


def _link(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "nombre_id long, nombre string")
    return {r["nombre_id"]: r["entidad"] for r in N.link_spellings(df).collect()}


def test_groups(spark):
    texts = [t for g in SAME for t in g]
    got = _link(spark, texts)
    start = 0
    for g in SAME:
        assert {got[i] for i in range(start, start + len(g))} == {start}, g
        start += len(g)


def test_ambiguous_abbreviation_stays_alone(spark):
    got = _link(spark, ["Banco Kegritova Taferva", "Banco Kegritova Tibalyane", "Banco Kegritova T."])
    assert len(set(got.values())) == 3


def test_empty_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, None), (None, "Banco A"), (2, "Banco Uno Dos"), (2, "Banco Uno Dos"), (3, ""), (4, "?" * 5000)], "nombre_id long, nombre string")
    assert {r["nombre_id"]: r["entidad"] for r in N.link_spellings(df).collect()} == {2: 2, 3: 3, 4: 4}
    assert N.link_spellings(df.limit(0)).count() == 0
    assert N.same_entity(N.link_spellings(df)).count() == 0


def test_hot_blocks_keep_their_links(spark, monkeypatch):
    r = random.Random(5)
    syl = ["ba", "co", "dri", "fe", "gu", "hue", "ji", "ke", "lo", "mon"]
    word = lambda: "".join(r.choice(syl) for _ in range(4)).capitalize()
    texts = []
    for _ in range(40):
        w = word()
        texts += [f"Banco Kemaferple {w}", f"BCO. KEMAFERPLE {w.upper()}", f"Banco Kemaferpe {w} S.A."]
    want = _link(spark, texts)
    monkeypatch.setattr(N, "HOT_KEY", 20)
    assert _link(spark, texts) == want


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a if a != b else root.get(b, b)
    nodes = sorted({x for e in edges for x in e} | {5000})
    got = {x["_id"]: x["label"] for x in N.components(spark.createDataFrame([(n,) for n in nodes], "_id long"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in nodes}


@pytest.mark.parametrize(("a", "b", "low", "high"), [("MARTHA", "MARHTA", 0.961, 0.962), ("DWAYNE", "DUANE", 0.84, 0.841), ("", "X", 0, 0), ("A", "A", 1, 1)])
def test_jaro_winkler(a, b, low, high):
    assert low <= N.jaro_winkler(a, b) <= high


def test_links_of_shared_tax_ids(spark, data):
    """Held-out evidence that the operator doesn't read: spellings filed under one real tax id are one entity."""
    folder = data.replace("sf0.001", "sf0.1")
    names = spark.read.parquet(f"{folder}/cmf_v2024.parquet")
    spellings = N.spellings_of(spark.read.parquet(f"{folder}/fact_derivado.parquet"), names)
    got = {r["nombre_id"]: r["entidad"] for r in N.link_spellings(spellings).collect()}
    by = {}
    for r in names.where("rut > 910000000 AND rut < 990000000").select("rut", "nombre_id").distinct().collect():
        by.setdefault(r["rut"], set()).add(r["nombre_id"])
    pairs = [got[a] == got[b] for s in by.values() for a, b in itertools.combinations(sorted(s), 2)]
    assert sum(pairs) >= 0.97 * len(pairs) > 100


def test_hot_blocks_compare_every_pair(spark, monkeypatch):
    """Missing words, initials that only sound alike and lost letters, in blocks of any size."""
    r = random.Random(7)
    syl = ["ba", "dri", "fe", "gu", "lo", "mon", "ti", "su"]
    texts = [f"Banco Kemaferple {''.join(r.choice(syl) for _ in range(5)).capitalize()}" for _ in range(60)]
    texts += ["Banco Renorundor Jiquenici", "Banco Renorundor", *(f"Banco Renorundor Jiqu{x}nici" for x in "aou")]
    texts += [f"Banco Renorundor Jiquenic{'iea'[i % 3] * (i // 3 + 1)}" for i in range(30)]
    texts += ["Vanina Kemaferple Velquehue", "B. Kemaferple Velquehue", "Banco Kemaferple �.", "Banco Taferva Kegritova", "Banco Taferva �."]
    texts += [f"Banco Taferva Kegritov{x}" for x in "aeiou"]
    want = _link(spark, texts)
    assert want[61] == want[60]
    monkeypatch.setattr(N, "HOT_KEY", 6)
    assert _link(spark, texts) == want


def test_bound_of_similarity_holds():
    r = random.Random(3)
    words = ["".join(r.choice("ABEKLMNRT?") for _ in range(r.randint(4, 9))) for _ in range(150)]
    letters = N._Letters(words)
    assert all(u >= N.jaro_winkler(words[i], words[j]) - 1e-9 for j in range(150) for i, u in enumerate(letters.bound(j, letters)))


@pytest.mark.parametrize("hot", [1, 20, 2000])
def test_every_kind_of_spelling_whatever_the_block(spark, monkeypatch, hot):
    """Further words, words in another order, initials, missing and cut words, several kinds of organisation, in blocks split at any size."""
    groups = [
        ["Banco Kemaferple Tapelquehue Norandino", "BCO KEMAFERPLE TAPELQUHUE NORANDINO SA", "Banco Kemaferpel Tapelquehue Norandno"],
        ["Banco Kemaferple Tapelquehue Surcolina", "bco. kemaferple tapelquehue surcolina"],
        ["Banco Kemaferple Tapelquehue"],  # fits both of the above
        ["Banco Velmisote Quirandopa", "Banco Quirandopa Velmisote", "BCO. QUIRANDOPA VELMISTE S.A.", "Banco Velmisote Q."],
        ["Banco Renorundor Jiquenici Oriental", "Banco Renorundor Jiquenici", "Banco Renorundor J.", "Banco Renorundor"],
        ["Hospital Kemaferple Tapelquehue", "HOSPITAL KEMAFERPLE TAPELQUHUE"],
        ["Universidad Kemaferple Tapelquehue", "Universidad Tapelquehue Kemaferple"],
        ["Kemaferple Tapelquehue Mining plc", "KEMAFERPLE TAPELQUEHUE MINING"],
        ["Banco Falandoro T.", "Banco Falandroo T."],
        ["Graciela Ketobavó Talupledrá", "Talupledrá Ketobavó, Graciela", "G. Ketobavó Talupledrá"],
        ["Pedro Ketobavó Talupledrá Norandino", "PEDRO KETOBAVO TALUPLEDRA NORANDINO"],
        ["Pedro Ketobavó Talupledrá Surcolina"],
    ]
    monkeypatch.setattr(N, "HOT_KEY", hot)
    got = _link(spark, [t for g in groups for t in g])
    start, want = 0, {}
    for g in groups:
        want |= {start + i: start for i in range(len(g))}
        start += len(g)
    same = lambda d: {frozenset(k for k in d if d[k] == v) for v in set(d.values())}
    assert same(got) == same(want)


def test_words_as_heard(spark):
    """Doubled letters, and sounds written in other ways, where the typed words are too far apart."""
    texts = ["Securitizadora Dogótado Luhuedufer", "Securitizadora Doogótado Luuhuedufer N.A.", "Securitiz. Ramaferque Kepelqueya", "securitiz. ramaferque-kpelkeya n.a.", "Banco Monchaqueva Cicortomi", "Banco Monchaluba Cicorchatra"]
    texts += ["Togüecortra Grimondoxa, Jesús Elías", "Toguecortra, Chuy E. G."]
    got = _link(spark, texts)
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6, 7: 6}


def test_lines_of_business_from_a_table(spark):
    texts = ["Panificadora Kemaferple Tapelquehue", "PANIF. KEMAFERPLE TAPELQUEHUE", "Banco Kemaferple Tapelquehue"]
    df = spark.createDataFrame(list(enumerate(texts)), "nombre_id long, nombre string")
    got = {r["nombre_id"]: r["entidad"] for r in N.link_spellings(df, {"PANIFICADORA": ["PANIFICADORA", "PANIF"], "BANCO": ["BANCO"]}).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_several_consonants_missing_and_names_cut_at_the_field(spark):
    cut = "910488078 Administradora General de Fondos Lusanluuven Ferta"
    assert len(cut) == N.WIDTH
    got = _link(spark, ["Administradora General de Fondos Lusanluven Fertachapel Ltda", "AGF Lusanluven Fertachapel", cut, "AGF Lusanluven Tibalyane", "Banco Kemaferple Tapelquehuendril", "Banco Kemaferple Tapelquehue"])
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4}


def test_cut_name_that_fits_two_stays_alone(spark):
    cut = "910488078 Administradora General de Fondos Lusanluuven Ferta"
    got = _link(spark, ["AGF Lusanluven Fertachapel", "AGF Lusanluven Fertalmibos", cut])
    assert got == {0: 0, 1: 1, 2: 2}


def test_entities_without_a_full_spelling(spark, monkeypatch):
    texts = ["Banco Falabella", "BCO FALABELA", "Banco Renca", "Banco Sol Kemaferple", "BCO. SOL KEMAFERPE SA", "Banco Sur Kemaferple", "Inversiones Tapelquehue D.", "INVERSIONES TAPELQUHUE D.", "Inversiones Tapelquehue M."]
    want = {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8}
    assert _link(spark, texts) == want
    monkeypatch.setattr(N, "HOT_KEY", 2)
    assert _link(spark, texts) == want


def test_person_filed_with_one_surname(spark, monkeypatch):
    texts = ["Graciela Ketobavó Talupledrá", "Graciela Ketobavó", "Roberto Mixavorun Silrosmar", "Roberto Mixavorun Baldorba", "Roberto Mixavorun"]
    want = {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
    assert _link(spark, texts) == want
    monkeypatch.setattr(N, "HOT_KEY", 2)
    assert _link(spark, texts) == want
