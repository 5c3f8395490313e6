import datetime as dt
import random

from lumbra.operators import snapshots

S = "periodo int, fecha_descarga date, rut_compania long, folio_operacion string, contraparte_key string, moneda string, fecha_vencimiento date, nocional_m double, n string, cambio int"
D = dt.date


def _df(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], S)


def _got(df):
    return {(r["periodo"], r["rut_compania"], r["folio_operacion"], r["cambio"]) for r in snapshots.position_changes(df).collect()}


def test_cases(spark):
    v = D(2026, 1, 1)
    rows = [
        (202501, D(2025, 2, 1), 1, "0001", "CP_1", "UF", v, 10.0), (202501, D(2025, 2, 1), 1, "2", "CP_1", "UF", v, 20.0), (202501, D(2025, 2, 1), 1, "3", "CP_1", "UF", None, 30.0), (202501, D(2025, 2, 1), 1, "4", "CP_1", "UF", v, None),
        (202503, D(2025, 4, 1), 1, "9", "CP_1", "UF", v, 1.0),  # an earlier delivery, replaced as a whole
        (202503, D(2025, 4, 9), 1, " 1 ", "cp_1 ", "uf", v, 10.0000004), (202503, D(2025, 4, 9), 1, "2", "CP_1", "UF", v, 20.002), (202503, D(2025, 4, 9), 1, "03", "CP_1", "UF", v, 30.0), (202503, D(2025, 4, 9), 1, "5", "CP_1", "UF", v, 5.0),
        (202503, D(2025, 4, 9), 1, "5", "cp_1", "uf", v, 5.0), (202503, D(2025, 4, 9), 1, "x", "CP_1", "UF", v, 5.0), (202503, D(2025, 4, 9), 1, None, "CP_1", "UF", v, 5.0),
        (202503, D(2025, 4, 9), 2, "1", "CP_1", "UF", v, 5.0),
    ]
    assert _got(_df(spark, rows)) == {(202503, 1, 2, "changed"), (202503, 1, 3, "changed"), (202503, 1, 4, "removed"), (202503, 1, 5, "added")}
    assert _got(_df(spark, rows).limit(0)) == set()


def test_random_against_brute_force(spark):
    r = random.Random(3)
    state = {c: {f: [r.choice("AB"), r.choice(["UF", "USD"]), None, float(r.randrange(100))] for f in range(400)} for c in (1, 2)}
    rows, want = [], set()
    for k, p in enumerate((202501, 202502, 202504)):
        for c in (1, 2):
            old = {f: list(x) for f, x in state[c].items()}
            if k:
                for f in r.sample(sorted(state[c]), 12):
                    del state[c][f]
                for _ in range(9):
                    state[c][r.randrange(1000, 2000)] = ["A", "UF", None, 7.0]
                for f in r.sample(sorted(state[c]), 15):
                    state[c][f][3] += r.choice([0.0005, 5.0])
            new = state[c]
            if k:
                want |= {(p, c, f, "added") for f in new.keys() - old.keys()} | {(p, c, f, "removed") for f in old.keys() - new.keys()}
                want |= {(p, c, f, "changed") for f in new.keys() & old.keys() if new[f][:3] != old[f][:3] or abs(new[f][3] - old[f][3]) > 0.001}
            rows += [(p, D(2025, 6, k + 1), c, str(f), *x) for f, x in new.items()]
    assert _got(_df(spark, rows)) == want


def test_digests_prune(spark):
    """One changed row of 5,000 makes one leaf unequal, at every depth of the tree."""
    rows = [(p, D(2025, 6, 1), 1, str(f), "A", "UF", None, float(f) + (p == 202502 and f == 7)) for p in (202501, 202502) for f in range(5000)]
    snaps = snapshots.clean_positions(_df(spark, rows)).cache()
    assert [snapshots.levels_for(n) for n in (0, 1024, 1025, 10**9)] == [1, 1, 2, 6]
    for levels in (1, 2, 4):
        leaves = snapshots.leaf_digests(snaps, ["rut_compania", "periodo"], ["folio_operacion"], [snaps["nocional_m"]], levels)
        got = snapshots.unequal_leaves(leaves, "rut_compania", "periodo", levels).collect()
        assert [(r["rut_compania"], r["periodo"], r["_before"]) for r in got] == [(1, 202502, 202501)]
    assert _got(_df(spark, rows)) == {(202502, 1, 7, "changed")}
