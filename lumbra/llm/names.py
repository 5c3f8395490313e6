"""Variant spellings of names typed by people.

Distinct spellings are read into parts: line of business, or given name, and all of the name's own words. Phonetic codes
of the sorted words give blocking keys; spellings that share a key are compared by Jaro-Winkler similarity of their
words, in either order of the first two, a nickname table standing for given names; accepted pairs are clustered by
connected components. Spellings with all their words settle the clusters first; a cluster that lacks further words joins
the one it fits, if that is one; then a spelling that has only an initial of a word, or no given name, joins a cluster
only if the clusters it fits are one. Those that fit no full spelling form clusters of their own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.llm.encoding import repair
from lumbra.session import buckets_for, checkpointed, ship

# Lines of business with their short forms.
BUSINESS: dict[str, list[str]] = {
    "BANCO": ["BANCO", "BCO", "BNCO"],
    "CORREDORES BOLSA": ["CORREDORES BOLSA", "CDB", "CDEB"],
    "COMPANIA SEGUROS": ["COMPANIA SEGUROS", "CIA SEGUROS", "CIA SEG", "COMP SEG"],
    "ADMINISTRADORA GENERAL FONDOS": ["ADMINISTRADORA GENERAL FONDOS", "ADMINISTRADORA FONDOS", "ADM GRAL FONDOS", "AGF"],
    "SOCIEDAD FINANCIERA": ["SOCIEDAD FINANCIERA", "FINANCIERA"],
    "AGENCIA VALORES": ["AGENCIA VALORES", "AV"],
    "INVERSIONES": ["INVERSIONES"],
    "SECURITIZADORA": ["SECURITIZADORA"],
    "INTERNATIONAL BANK": ["INTERNATIONAL BANK", "INTL BANK", "INTL BK"],
    "FUNDACION PREVISIONAL": ["FUNDACION PREVISIONAL"],
    "IRMAOS CORRETORA": ["IRMAOS CORRETORA"],
    "CONCEICAO SEGURADORA": ["CONCEICAO SEGURADORA"],
    "COOPERATIVA AHORRO CREDITO": ["COOPERATIVA AHORRO CREDITO", "COOPERATIVA AHORRO", "CAC"],
    "CREDIT FEDERAL": ["CREDIT FEDERAL", "CR FEDERAL"],
    "GROSSHANDEL KREDIT": ["GROSSHANDEL KREDIT"],
    "SAO PARTICIPACOES": ["SAO PARTICIPACOES"],
}
# Nicknames and short forms of given names.
NICKNAMES: dict[str, str] = {
    "ALEX": "ALEJANDRO", "ANDY": "ANDRES", "BEA": "BEATRIZ", "BETO": "ROBERTO", "CHABELA": "ISABEL", "CHARO": "ROSARIO", "CHELA": "GRACIELA",
    "CHUY": "JESUS", "CONCHA": "CONCEPCION", "CONCHITA": "CONCEPCION", "EDU": "EDUARDO", "FCO": "FRANCISCO", "GABY": "GABRIELA", "GUILLE": "GUILLERMO",
    "ISA": "ISABEL", "JANO": "ALEJANDRO", "KIKE": "ENRIQUE", "LALO": "EDUARDO", "LITO": "MANUEL", "LOLA": "DOLORES", "MA": "MARIA", "MANOLO": "MANUEL",
    "MECHE": "MERCEDES", "MEMO": "GUILLERMO", "NACHO": "IGNACIO", "NANO": "HERNAN", "NENA": "INES", "PACO": "FRANCISCO", "PANCHO": "FRANCISCO",
    "PEPE": "JOSE", "QUIQUE": "ENRIQUE", "SEBA": "SEBASTIAN", "SEBAS": "SEBASTIAN", "TICHA": "BEATRIZ", "TITO": "ROBERTO", "VERO": "VERONICA",
}
GIVEN = frozenset(NICKNAMES.values())
TITLES = frozenset("DON DONA DR DRA SR SRA".split())
# Legal forms; words of organisations that the lines of business leave open, each a line of its own where it stands unabridged.
LEGAL = frozenset("SA AG SPA LTDA LIMITADA NA ANONIMA PLC INC LLC LTD LP GMBH SE NV BV SAS SRL EIRL SARL CORP LIMITED".split())
GENERAL = frozenset(
    "HOSPITAL CLINICA CLINIC UNIVERSIDAD UNIVERSITY UNIVERSIDADE COLEGIO SCHOOL ESCUELA INSTITUTO INSTITUTE FUNDACION FOUNDATION FUNDACAO CORPORACION CORPORATION ASOCIACION ASSOCIATION MUNICIPALIDAD MINISTERIO "
    "CAJA CAIXA FONDO FUND CONSTRUCTORA CONSTRUTORA INMOBILIARIA COMERCIAL INDUSTRIAS INDUSTRIES MINERA MINING TRANSPORTES HOLDING HOLDINGS GROUP GRUPO TRUST PARTNERS COMPANY EMPRESA EMPRESAS INSURANCE ENERGIA ENERGY".split()
)
LINKING = frozenset("DE DA DO DEL LA".split())
#: Least Jaro-Winkler similarity of each word, and least mean over the words.
LEAST_WORD, LEAST_MEAN = 0.82, 0.90
#: The same of words as heard, where words as typed are too far apart; also of the only full word of an abbreviated spelling.
HEARD_WORD, HEARD_MEAN = 0.85, 0.93
#: Least similarity of the only full word of an abbreviated spelling, and how much its best cluster must beat the next.
LEAST_ONLY, MARGIN = 0.88, 0.03
#: Members of a blocking key above which its pairs are spread over tiles of about so many members.
HOT_KEY = 2_000
#: Rounds of stars after which something is wrong: they grow with the logarithm of the longest chain, squared at most.
MOST_ROUNDS = 200
#: Width of the name field. A word that reaches its end may be cut and is marked.
WIDTH, CUT = 60, "."


def fold(s: str) -> str:
    """Repaired, without accents, in capitals; a lost letter is `?`."""
    s = unicodedata.normalize("NFKD", repair(s)[1].replace("ß", "ss"))
    s = "".join(c for c in s if not unicodedata.combining(c)).upper()
    s = re.sub("�{1,2}", "?", s).replace("'", "")
    return re.sub(r"\b((?:[A-Z]\.){2,}[A-Z]?)(?=\W|$)", lambda m: m[1].replace(".", ""), s)


@lru_cache(200_000)
def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    used, hits = [False] * m, []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not used[j] and (b[j] == c or c == "?" or b[j] == "?"):
                used[j] = True
                hits.append((c, b[j]))
                break
    k = len(hits)
    if not k:
        return 0.0
    other = [c for c, u in zip(b, used) if u]
    swaps = sum(x[0] != y and "?" not in (x[0], y) for x, y in zip(hits, other)) / 2
    jaro = (k / n + k / m + (k - swaps) / k) / 3
    start = 0
    while start < min(4, n, m) and a[start] == b[start]:
        start += 1
    return jaro + 0.1 * start * (1 - jaro)


@lru_cache(200_000)
def sounds(word: str) -> str:
    """A word as Spanish speakers hear it, vowels included: one letter a sound, doubled letters once."""
    w = word.replace("QU", "K").replace("GUE", "GE").replace("GUI", "GI")
    w = re.sub("C(?=[EI])", "S", w).translate(str.maketrans("CQZVW", "KKSBB"))
    return re.sub(r"(.)\1+", r"\1", w)


def _near(t: str, w: str) -> bool:
    """A typed word is this known word, its beginning, or a typo of it."""
    if t == w or len(t) >= 2 and w.startswith(t):
        return True
    if "?" in t:
        return bool(re.fullmatch(t.replace("?", ".{0,2}"), w))
    return len(t) >= 4 and abs(len(t) - len(w)) <= 2 and t[0] == w[0] and jaro_winkler(t, w) >= 0.92 or len(t) == 1 and w[0] == t


def phrases(business: dict[str, list[str]]) -> list[tuple[list[str], str]]:
    """(words, line of business), the longest first. business: lines with their short forms, such as a table gives."""
    out = [(p.split(), b) for b, ps in business.items() for p in ps]
    return sorted(out, key=lambda x: (-len(x[0]), x[0]))


_OWN = phrases(BUSINESS)


def _business(tokens: list[str], known: list[tuple[list[str], str]]) -> tuple[str | None, list[str]]:
    """Line of business and the tokens without it. The most and longest matched words win; without a line, a general word is one."""
    best = None
    for words, name in known:
        for i in range(len(tokens) - len(words) + 1):
            part = tokens[i : i + len(words)]
            if len(words) == 1:
                ok = part[0] == words[0] or len(words[0]) >= 5 and len(part[0]) >= 3 and _near(part[0], words[0])
            else:
                ok = all(map(_near, part, words)) and any(len(t) >= 3 for t in part) and sum(len(t) == 1 for t in part) <= 1
            if ok:
                score = (len(words), sum(map(len, part)), -i)
                if best is None or score > best[0]:
                    best = (score, name, tokens[:i] + tokens[i + len(words) :])
    if best:
        return best[1], best[2]
    cut = tokens[:-1] if tokens and tokens[-1] == "D" else tokens  # the field may end within the phrase
    for words, name in known:
        for k in range(min(len(words), len(cut)) - 1, 0, -1):
            part = cut[-k:]
            if len(part[0]) >= 3 and len(words[0]) > 3 and all(map(_near, part, words)):
                return name, cut[:-k]
    general = next((t for t in tokens if t in GENERAL), None)
    return general, [t for i, t in enumerate(tokens) if general is None or i != tokens.index(general)]


def read(spelling: str, known: list[tuple[list[str], str]] | None = None) -> tuple[str, str, str, str, str]:
    """(kind, first, word 1, word 2, further words): kind is a line of business, ORG or P; first is a person's canonical given name or initial."""
    s = fold(spelling)
    s = re.sub(r"\bC\W+DE\W+B\b", "CDEB", s)
    s = re.sub(r"\bAHORRO\W+[YE]\W+", "AHORRO ", s)
    s = re.sub(r"\bSUC(?:URSAL)?\b\W*\w*", " ", s)
    s = re.sub(r"\bS\W+A\W*$|\bN\W+A\W*$", " ", s)
    s = re.sub(r"\bS\W+P\W+A\W*$", " ", s)
    tokens = [t for t in re.findall(r"[A-Z?]+", re.sub(r"\d+", " ", s)) if t not in LINKING]
    comma = s.split(",")[0] if "," in s else ""
    name, rest = _business(tokens, _OWN if known is None else known)
    if name is None and "SOCIEDAD" in tokens and "ANONIMA" in tokens:
        rest = [t for t in tokens if t not in ("SOCIEDAD", "ANONIMA")]
    legal = [t for t in rest if t in LEGAL]
    rest = [t for t in rest if t not in LEGAL and not (name and t == "SOCIEDAD")]
    if name or legal:
        rest = [t for t in rest if t != "SOCIEDAD"]
        long = [t for t in rest if len(t) > 1]
        first = long[0] if long else (rest[0] if rest else "")
        after = rest[rest.index(first) + 1 :] if first else []
        if len(after) > 1 and after[-1] == tokens[-1] and len(spelling) >= WIDTH and any(f.startswith(after[-1]) for f in (*LEGAL, "SOCIEDAD")):
            after.pop()  # the field ended within the legal form
        return name or "ORG", "", *_cut_marked(spelling, tokens, [first, *after[:1], *[t for t in after[1:] if len(t) > 1]])
    rest = [t for t in rest if t not in TITLES]
    given, long, initials = [], [], []
    for i, t in enumerate(rest):
        canon = NICKNAMES.get(t) or (t if t in GIVEN else None)
        if canon is None and len(t) >= 4:
            near = max(GIVEN, key=lambda g: (jaro_winkler(t, g), g))
            canon = near if jaro_winkler(t, near) >= 0.93 and abs(len(t) - len(near)) <= 2 else None
        if canon:
            given.append((i, canon))
        elif len(t) == 1:
            initials.append((i, t))
        else:
            long.append((i, t))
    if not given and len(long) >= 3:
        n_before = len(re.findall(r"[A-Z?]{2,}", comma))
        at = n_before if comma and n_before < len(long) else 0
        given.append(long.pop(at))
    first, second = (long[0][1] if long else ""), (long[1][1] if len(long) > 1 else "")
    if len(long) == 1:
        later = [x for x in initials if x[0] > long[0][0]]
        if later:
            # after a comma behind the first surname alone the order is given name, middle name, second surname
            at = later[-1] if len(re.findall("[A-Z?]+", comma)) == 1 else later[0]
            second = at[1]
            initials.remove(at)
    named = sorted(given + initials)
    return "P", named[0][1] if named else "", *_cut_marked(spelling, tokens, [first, second, *[t for _, t in long[2:]]])


def _cut_marked(spelling: str, tokens: list[str], words: list[str]) -> tuple[str, str, str]:
    """The first word, the second, and the others joined; the last one is marked if it ends where the field does."""
    words = [*words, "", ""][: max(2, len(words))]
    at = max((i for i, w in enumerate(words) if w), default=0)
    last = words[at]
    if len(last) > 1 and len(spelling) >= WIDTH and tokens[-1] == last and (spelling[-1].isalpha() or ord(spelling[-1]) > 127):
        words[at] += CUT
    return words[0], words[1], " ".join(words[2:])


_VOWELS = str.maketrans("", "", "AEIOUH?" + CUT)


@lru_cache(200_000)
def phonetic(word: str) -> str:
    """Consonants as Spanish speakers hear them, without doubles; vowels and H are silent."""
    w = word.replace("QU", "K").replace("GUE", "GE").replace("GUI", "GI").replace("CH", "X").replace("LL", "Y")
    w = re.sub("C(?=[EI])", "S", w).translate(str.maketrans("CQZVWÑJ", "KKSBBNG")).translate(_VOWELS)
    return re.sub(r"(.)\1+", r"\1", w)


@lru_cache(200_000)
def _reduced(code: str) -> list[str]:
    """The code and all codes with one consonant less, without doubles, so that codes one edit apart share one."""
    less = {re.sub(r"(.)\1+", r"\1", code[:i] + code[i + 1 :]) for i in range(len(code))} if len(code) > 2 else set()
    return sorted({code, *less})


def keys(kind: str, first: str, one: str, two: str, rest: str = "") -> list[str]:
    """Blocking keys: a word's reduced codes with the kind and, of persons, the initial sound of the other word, or nothing, for who is filed with one surname."""
    out = []
    for a, b in ((one, two), (two, one)):
        if len(a) > 2:
            start = b[:1].translate(str.maketrans("CQZVJ", "KKSBG"))
            out += [f"{kind}|{c}{end}" for c in _reduced(phonetic(a)) for end in ({f"|{start}", "|"} if kind == "P" else [""])]
    return sorted(set(out)) or [f"{kind}|{one}|{two}|{first}"]


def shape(p: tuple) -> tuple:
    """Which parts are there, and how: a word of over three letters, shorter, cut or none; a given name, its initial or none."""
    return p[0], min(len(p[1]), 2) if p[0] == "P" else 0, *((w.endswith(CUT), min(len(w), 4)) for w in p[2:4]), len(p[4].split())


def _same_words(pairs: list[tuple[str, str]], heard: bool = False) -> tuple[int, list[float]]:
    """(strength, similarities) of words that stand at the same places: 2 all full, 1 as far as initials, cut or missing words tell, 0 different."""
    strength, sims = 2, []
    for x, y in pairs:
        ends = [len(w) - 1 for w in (x, y) if w.endswith(CUT)]
        if ends:  # compared as far as the field reached
            x, y, strength = x[: min(ends)], y[: min(ends)], 1
        if len(x) > 3 and len(y) > 3:
            sim = jaro_winkler(sounds(x), sounds(y)) if heard else jaro_winkler(x, y)
            if sim < (HEARD_WORD if heard else LEAST_WORD):
                return 0, []
            sims.append(sim)
        elif x and y and not (x.startswith(y) or y.startswith(x) or "?" in (x[0], y[0])):
            return 0, []
        else:
            strength = 1
    return strength, sims


def _enough(pairs: list[tuple[str, str]]) -> tuple[int, float]:
    """(strength, mean similarity) of words as typed, or else as heard, since a doubled letter shifts all that follow it; 0 if neither is near enough."""
    for heard in (False, True):
        strength, sims = _same_words(pairs, heard)
        mean = sum(sims) / len(sims) if sims else 0.0
        if strength and sims and mean >= (HEARD_MEAN if heard else LEAST_MEAN if len(sims) > 1 else LEAST_ONLY):
            return strength, mean
    return 0, 0.0


def alike(a: tuple, b: tuple) -> tuple[int, float]:
    """(strength, similarity); strength 2: the same by full words, 4: by full words, but one side lacks further words, 1: as far
    as initials or missing parts tell, 0: different.

    Sides are (kind, first, one, two, rest). The first two words may stand in the other order if all are full."""
    if a[0] != b[0]:
        return 0, 0.0
    strength = 2
    if a[0] == "P":
        x, y = a[1], b[1]
        if len(x) > 1 and len(y) > 1:
            if x != y and (x in GIVEN and y in GIVEN or jaro_winkler(x, y) < 0.9):
                return 0, 0.0
        elif x and y and x[0] != y[0]:
            return 0, 0.0
        else:
            strength = 1
    got = _enough([(a[2], b[2]), (a[3], b[3])])
    if not got[0] and min(map(len, (*a[2:4], *b[2:4]))) > 3:
        got = _enough([(a[2], b[3]), (a[3], b[2])])
    if not got[0] or not (a[4] or b[4]):
        return (min(strength, got[0]), got[1]) if got[0] else (0, 0.0)
    mine, its = a[4].split(), b[4].split()
    further, sims = _same_words(list(zip(mine, its)))
    if not further:
        return 0, 0.0
    strength = min(strength, got[0], further)
    if len(mine) != len(its) and strength == 2:
        strength = 4
    return strength, (got[1] * 2 + sum(sims)) / (2 + len(sims))


def is_full(p: tuple) -> bool:
    """All its words are there: both words, neither cut, and of a person the given name."""
    return len(p[2]) > 3 and len(p[3]) > 3 and CUT not in p[2] + p[3] and (p[0] != "P" or len(p[1]) > 1)


PARTS = "kind string, first string, one string, two string, rest string"
COLUMNS = ["kind", "first", "one", "two", "rest"]


def _read_all(known: list[tuple[list[str], str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [read(x, known) for x in b["nombre"]]
            yield pd.DataFrame({"nombre_id": b["nombre_id"], **{c: [g[i] for g in got] for i, c in enumerate(COLUMNS)}})

    return run


def _keys_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = list(zip(*(b[c] for c in COLUMNS)))
        ks = [keys(*p) for p in parts]
        n = [len(k) for k in ks]
        yield pd.DataFrame({"_key": [k for own in ks for k in own], "_id": np.repeat(b["_id"].to_numpy(), n), **{c: np.repeat(b[c].to_numpy(dtype=object), n) for c in COLUMNS}})


class _Letters:
    """Letter counts and first letters of words, for an upper bound of their Jaro-Winkler similarities."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words])
        self.bag = np.array([[w.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ?"] for w in words], dtype=np.int16)
        self.lead = np.array([[ord(c) for c in w[:4].ljust(4)] for w in words])

    def bound(self, j: int, its: _Letters) -> np.ndarray:
        """Bound of the similarity of word j of `its` with each of these words before place j."""
        common = np.minimum(self.bag[:j, :26], its.bag[j, :26]).sum(axis=1) + self.bag[:j, 26] + its.bag[j, 26]
        k = np.minimum(common, np.minimum(self.size[:j], its.size[j]))
        jaro = (k / self.size[:j] + k / its.size[j] + 1) / 3
        return jaro + 0.1 * np.cumprod(self.lead[:j] == its.lead[j], axis=1).sum(axis=1) * (1 - jaro)


def _before(full: list[tuple]):
    """f(j): places before j of the full spellings that may be alike to the one at j, in either order of their words."""
    if len(full) < 50:
        return range
    one, two = ([_Letters([f(p[c]) for _, p, _ in full]) for f in (str, sounds)] for c in (2, 3))

    def places(j: int) -> list[int]:
        out = np.zeros(j, bool)
        for a, b, word, mean in ((one[0], two[0], LEAST_WORD, LEAST_MEAN), (one[1], two[1], HEARD_WORD, HEARD_MEAN)):
            for x, y in ((a.bound(j, a), b.bound(j, b)), (a.bound(j, b), b.bound(j, a))):
                out |= (x >= word - 1e-9) & (y >= word - 1e-9) & (x + y >= 2 * mean - 1e-9)
        return np.flatnonzero(out).tolist()

    return places


def _link_block(members: list[tuple]) -> list[tuple]:
    """(a, b, strength, sim): spanning strong links, for each abbreviation its link into each local cluster that may be its best, and with
    strength 4 links of full spellings to such with more words, one a pair of local clusters.

    Abbreviations that fit no full spelling here are linked, with strength 3, to those that have the same parts.

    Members are (id, parts, share of a hot key). In a tile of two shares only pairs across them are compared."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    across = len({m[2] for m in members}) > 1
    full = [m for m in members if is_full(m[1])]
    before = _before(full)
    out, more = [], []
    for j, (b, q, t) in enumerate(full):
        for i in before(j):
            a, p, u = full[i]
            if not (across and t == u) and find(a) != find(b):
                strength, sim = alike(p, q)
                if strength == 2:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
                    out.append((a, b, 2, sim))
                elif strength == 4:
                    more.append((a, b, sim) if len(p[4].split()) > len(q[4].split()) else (b, a, sim))
    longer: dict[tuple, tuple] = {}
    for a, b, sim in more:
        longer[find(a), find(b)] = max(longer.get((find(a), find(b)), (0.0, 0, 0)), (sim, -a, -b))
    out += [(-a, -b, 4, sim) for sim, a, b in longer.values()]
    alone: dict[tuple, list] = {}
    for b, q, t in members:
        if is_full(q):
            continue
        best: dict[int, tuple] = {}
        for a, p, u in full:
            strength, sim = (0, 0.0) if across and t == u else alike(p, q)
            if strength:
                best[find(a)] = max(best.get(find(a), (0.0, 0)), (sim, -a))
        top = max((sim for sim, _ in best.values()), default=0.0)
        out += [(-a, b, 1, sim) for sim, a in best.values() if sim > top - MARGIN]
        if not best:
            alone.setdefault(shape(q), []).append((b, q, t))
    for group in alone.values():
        for j, (b, q, t) in enumerate(group):
            got = ((a, alike(p, q)) for a, p, u in group[:j] if not (across and t == u))
            out += [(a, b, 3, sim) for a, (strength, sim) in got if strength]
    return out


def _link_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks arrive sorted by key; one block is held at a time."""
    key, members, out = None, [], []
    cols = ["a", "b", "strength", "sim"]
    for b in batches:
        for k, i, t, *p in zip(b["_key"], b["_id"], b["_share"], *(b[c] for c in COLUMNS)):
            if k != key:
                out += _link_block(members) if len(members) > 1 else []
                key, members = k, []
            members.append((i, tuple(p), t))
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=cols)
            out = []
    out += _link_block(members) if len(members) > 1 else []
    yield pd.DataFrame(out, columns=cols)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(_id, label): label is the least id of the component. Alternating large and small stars, each round checkpointed.

    A round only aggregates and joins by node, so no component ever meets in one task."""
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        stars = down.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(m.select("u", F.col("m").alias("v"))).distinct()
        edges = checkpointed(stars)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components: no end after MOST_ROUNDS rounds")
    return nodes.join(edges.select(F.col("u").alias("_id"), F.col("v").alias("_v")), "_id", "left").select("_id", F.coalesce("_v", "_id").alias("label"))


def _clear_best(weak: DataFrame, of: str) -> DataFrame:
    """(of, to): the best cluster `to` of each `of`, if it leads the next by MARGIN; of the rows only the two best of each are kept."""
    rank = F.row_number().over(Window.partitionBy(of).orderBy(F.desc("sim"), "to"))
    best = weak.groupBy(of, "to").agg(F.max("sim").alias("sim")).withColumn("_k", rank).where("_k <= 2")
    best = best.groupBy(of).agg(F.max(F.when(F.col("_k") == 1, F.struct("sim", "to"))).alias("x"), F.max(F.when(F.col("_k") == 2, F.col("sim"))).alias("y"))
    return best.where(F.col("y").isNull() | (F.col("x.sim") - F.col("y") >= MARGIN)).select(of, F.col("x.to").alias("to"))


def link_spellings(spellings: DataFrame, business: dict[str, list[str]] | None = None) -> DataFrame:
    """(nombre_id, entidad): the entity of each distinct spelling, named by the least nombre_id of its settled spellings.

    spellings: nombre_id, nombre. business: lines of business with their short forms, such as a table gives; BUSINESS if none
    is given. Null names and ids are left out; of rows with one id the least name counts. Spellings
    that read alike fall together before any comparison, so repeats and case or accent variants cost nothing further.
    An abbreviation, or a cluster without the further words of two others, that fits both nearly equally well stays alone; those that fit none are linked with each other if
    they have the same parts, so an entity without a full spelling is one too. Empty input gives no rows."""
    spark = spellings.sparkSession
    ship(spark)
    one = spellings.select(F.col("nombre_id").cast("long").alias("nombre_id"), F.col("nombre").cast("string").alias("nombre")).dropna().groupBy("nombre_id").agg(F.min("nombre").alias("nombre"))
    read_rows = checkpointed(one.repartition(buckets_for(spellings)).mapInPandas(_read_all(_OWN if business is None else phrases(business)), f"nombre_id long, {PARTS}"))
    parts = COLUMNS
    reps = read_rows.groupBy(*parts).agg(F.min("nombre_id").alias("_id"))
    member = f"_key string, _id long, {PARTS}"
    keyed = checkpointed(reps.mapInPandas(_keys_all, member))
    # keys of persons without the other word's initial serve only where a single surname has one
    single = keyed.where("kind = 'P' AND (one = '' OR two = '') AND endswith(_key, '|')").select("_key").distinct()
    bare = F.expr("kind = 'P' AND endswith(_key, '|')")
    keyed = keyed.where(~bare).unionByName(keyed.where(bare).join(single, "_key", "left_semi"))
    # a hot key's members are dealt to shares, and every two shares meet in one tile, so all pairs are compared there too
    shares = keyed.groupBy("_key").count().where(F.col("count") > HOT_KEY).select("_key", F.ceil(F.col("count") / (HOT_KEY / 2)).alias("_shares"))
    marked = keyed.join(shares, "_key", "left")
    cold = marked.where("_shares IS NULL").drop("_shares").withColumn("_share", F.lit(0).cast("long"))
    hot = marked.where("_shares IS NOT NULL").withColumn("_share", F.expr("pmod(xxhash64(_id), _shares)")).withColumn("_with", F.explode(F.expr("sequence(0L, _shares - 1)")))
    hot = hot.withColumn("_key", F.concat_ws("|", "_key", F.lit(""), F.least("_share", "_with"), F.greatest("_share", "_with"))).drop("_shares", "_with")
    blocks = cold.unionByName(hot)
    blocks = blocks.repartition(buckets_for(spellings), "_key").sortWithinPartitions("_key", "_id")
    links = checkpointed(blocks.mapInPandas(_link_all, "a long, b long, strength int, sim double"))
    # abbreviations that fit a full spelling anywhere are settled by that alone, the others among themselves
    fits = links.where("strength = 1").select(F.col("b").alias("_fits")).distinct()
    among = links.where("strength = 3")
    for side in ("a", "b"):
        among = among.join(fits, F.col(side) == F.col("_fits"), "left_anti")
    strong = links.where("strength = 2").unionByName(among).select("a", "b")
    label = checkpointed(components(reps.select("_id"), strong))
    as_label = lambda side, name: label.withColumnsRenamed({"_id": side, "label": name})
    lacking = links.where("strength = 4").join(as_label("a", "to"), "a").join(as_label("b", "from"), "b").where("to <> from")
    joined = checkpointed(_clear_best(lacking, "from"))
    if not joined.isEmpty():
        label = checkpointed(components(reps.select("_id"), label.select(F.col("_id").alias("a"), F.col("label").alias("b")).unionByName(joined.select(F.col("from").alias("a"), F.col("to").alias("b")))))
    weak = links.where("strength = 1").join(as_label("a", "to"), "a")
    settled = _clear_best(weak, "b").select(F.col("b").alias("_id"), F.col("to").alias("_to"))
    final = label.join(settled, "_id", "left").select("_id", F.coalesce("_to", "label").alias("entidad"))
    ids = read_rows.join(reps, parts).select("nombre_id", "_id")
    return ids.join(final, "_id").select("nombre_id", "entidad")


def spellings_of(lines: DataFrame, names: DataFrame) -> DataFrame:
    """The distinct spellings of both tables."""
    a = lines.select("nombre_id", F.col("contraparte_nombre").alias("nombre")).distinct()
    return a.unionByName(names.select("nombre_id", "nombre").distinct()).distinct()


def same_entity(linked: DataFrame) -> DataFrame:
    """(nombre_id_a, nombre_id_b): all pairs of spellings of one entity, a < b; the result's definition asks for them all."""
    a = linked.select(F.col("nombre_id").alias("nombre_id_a"), "entidad")
    b = linked.select(F.col("nombre_id").alias("nombre_id_b"), "entidad")
    return a.join(b, "entidad").where("nombre_id_a < nombre_id_b").select("nombre_id_a", "nombre_id_b")
