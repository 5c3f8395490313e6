"""Template residue and error-page text.

A document is cut into passages. General phrases, response-status texts and marks of templates label passages of a
bounded sample weakly: residue, or ordinary text, among it text that only reports on templates, errors or scripts. A
regularized linear classifier on hashed word n-grams, n-grams of word shapes, length and title features is trained on
some hosts, and its threshold is set on hosts that it has not seen (a host is the company that a document comes from).
A document counts if one of its passages does, however long it is. Cutting, hashing and scoring are array operations
over batches of texts; no word is handled alone.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbra.session import ship, spread

#: Documents of the training sample, labelled passages kept of it, share of hosts held out.
SAMPLE_DOCUMENTS, SAMPLE_PASSAGES, HELD_OUT = 20_000, 30_000, 0.25
#: Hashed features as a power of two, passes, step, L2 penalty, least threshold.
BITS, PASSES, STEP, PENALTY, THRESHOLD = 18, 10, 0.5, 2e-5, 0.5
FEATURES = 1 << BITS
#: Share of the passages without any sign that are kept as ordinary; share of words that are unseen in copies of ordinary and of residue passages.
ORDINARY_SHARE, UNSEEN, MOSTLY = 0.08, 0.9, 0.75
#: Characters, and passages of the sample, that are handled at a time.
CHUNK, WHOLES = 1 << 20, 4_000
SEED = 7

# Marks by which templates hold a place open.
_SLOTS = re.compile(
    r"\{\{.*?\}\}|\{%.*?%\}|<<.*?>>|\$\{.*?\}|\$[A-Za-z_]{3,}\$|@@.*?@@|__\w+?__|_{4,}|%[A-Za-z_]{3,}%|#[A-Za-z_]{3,}#|#REF!|#N/A|#VALUE!|\{\w+\}|<[A-Za-zÀ-ÿ_ ]{2,40}>"
    r"|\[[A-Za-zÀ-ÿ_ ]{3,40}\]|\[●\]|\[_+\]|«[A-Za-zÀ-ÿ_ ]{3,40}»|\((?:indicar|insertar|completar|inserir|preencher|insert|complete)[^)]*\)|…{2,}|\.{6,}"
    r"|\bX{2,}(?:[ .]+de X{2,})*(?: de 20XX)?\b|\bXXX\.XXX\b|\bdd/mm/a{2,4}\b|\bdd/mm/yyyy\b|\bmm/dd/yyyy\b"
)
# Phrases of filler, of response statuses, and of notices on scripts, folded, in Spanish, English and Portuguese.
FILLER = re.compile(
    r"lorem ipsum|ipsum lorem|\byour (?:text|content|name|title) here|\binsert (?:text|title|date) here|\b(?:sample|placeholder|dummy|filler) (?:text|paragraph|content)|\bclick to (?:edit|add)|\bhaga clic para (?:editar|agregar)"
    r"|\b(?:texto|parrafo|paragrafo) de (?:ejemplo|prueba|exemplo|relleno|muestra|preenchimento)|\b(?:texto|parrafo) (?:ficticio|provisional|provisorio)|\b(?:aqui|aca) va (?:el|la|un|una)\b|\bpendiente de redaccion|\btext goes here|\bgoes here\b"
)
STATUS = re.compile(
    r"\bbad gateway|gateway time-?out|\b(?:internal|server) error|\bunexpected error|\berror (?:interno|inesperado)|\berro (?:interno|inesperado)|\b(?:page|pagina|site|sitio|recurso|documento|resource|file)\W+(?:\w+\W+){0,3}?(?:not found|could not be found|no (?:fue )?encontrad|nao encontrad)"
    r"|^\W*(?:error |http )?404\b\W*(?:not found)?|^\W*(?:http|error|erro)\W+(?:[45]\d\d)\b|\bservice (?:temporarily )?unavailable|\btemporarily unavailable|\bservicio no disponible|\bservico indisponivel|\baccess denied|\bacceso denegado|\bacesso negado|\bno tiene permisos?\b|\bnao tem permissao|\byou (?:do not|don't) have permission"
    r"|\btoo many requests|\bdemasiadas solicitudes|\bmuitas solicitacoes|\b(?:session|sesion|sessao) (?:has |ha )?(?:expired|expirado|caducado|expirou)|\b(?:sesion|sessao) expirada|\btiempo de espera agotado|\b(?:request|connection) timed? ?out|\b(?:en|em|under|por) (?:mantenimiento|manutencao|maintenance)\b"
    r"|\btraceback \(most recent|\bstack ?trace\b|\bfatal error\b|\bora-\d{4,5}|\b(?:nullpointer|runtime)exception|\b(?:key|value|type|runtime)error\b|\brequest id\W+[0-9a-f]{4}"
)
SCRIPTS = re.compile(
    r"\b(?:enable|enabling|habilit\w+|activ\w+|ativ\w+|requires?|requiere|exige|needs?|pide|pede|admite|support\w*|allow\w*|permit\w+|turn on)\W+(?:\w+\W+){0,4}?(?:javascript|scripts?|scripting|cookies)\b"
    r"|\b(?:javascript|scripts?|scripting|cookies)\W+(?:\w+\W+){0,5}?(?:enabled|disabled|required|turned on|desactivad\w*|deshabilitad\w*|habilitad\w*|permitid\w*|requerid\w*)|\b(?:not a robot|no es un robot|nao e um robo)\b|\bcaptcha\b"
)
# Words that residue and reports on it have in common; a passage with none of them, no mark of a template and no word over and over is ordinary.
SIGNS = (
    "lorem ipsum text texto parrafo paragrafo paragraph sample placeholder dummy filler click clic here relleno redaccion template plantilla maqueta modelo variable campo marca palabra xx xxx xxxx dd aaaa yyyy indicar insertar completar inserir preencher insert complete "
    "gateway error erro page pagina site sitio unavailable disponible indisponivel denied denegado negado permiso permisos permissao permission forbidden requests solicitudes solicitacoes session sesion sessao espera timed timeout mantenimiento manutencao maintenance "
    "traceback stack fatal ora exception nullpointerexception runtimeexception keyerror valueerror typeerror runtimeerror request http javascript script scripts scripting cookies robot robo captcha navegador browser acceso access acesso manual portal"
).split()
# Endings and forms of past tenses, and words that attribute; a report has them, a notice hasn't.
NARRATIVE = re.compile(
    r"\b[a-zñáéíóú]{2,}(?:ó|aron|ieron|ou|aram|eram|iram|aba|aban|ava|avam)\b|\b[a-zçãéíóú]{4,}(?:eu|iu)\b|\b(?:era|eran|fue|fueron|había|tenía|quiso|hubo|hizo|dijo|foi|foram|was|were|did|took|had|saw|made|went|came|gave|kept|sent|told|said|lasted|showed)\b|\b(?:según|segundo|according to|como variable)\b",
    re.I,
)
_INSTRUCTION = re.compile(r"insert|complet|indicar|preencher|inserir|nombre d|firmante|your name")
# Words without content, by which ordinary sentences are told from filler.
_STOP_WORDS = frozenset("de la el los las que y en un una por con para del se su es the of and to in is a for on with o os as do da em um uma não com que e".split())

_PLAIN = {i: unicodedata.normalize("NFKD", chr(i))[0] for i in range(0xC0, 0x250) if unicodedata.decomposition(chr(i))} | {i: None for i in range(0x300, 0x370)}


def folded(s: str) -> str:
    """Lower case without accents."""
    return (s if s.isascii() else s.translate(_PLAIN)).lower()


def weak_label(p: str) -> int | None:
    """1 residue, 0 ordinary, None if the signs are too faint to tell.

    Two places held open are a template, whatever the sentence says. A phrase of filler, status or scripts is residue unless
    the sentence reports in a past tense or attributes, or, of filler, gives figures; one place held open tells only with an
    instruction, or in a report. A few words over and over, and lorem or ipsum among words of no language, are filler."""
    s = folded(p)
    slots = len(_SLOTS.findall(p))
    if slots >= 2:
        return 1
    told = bool(NARRATIVE.search(p))
    if STATUS.search(s) or SCRIPTS.search(s):
        return 0 if told else 1
    words = re.findall(r"[a-z]+", s)
    if FILLER.search(s):
        return 0 if told or len(words) >= 8 and re.search(r"\d", s) else 1
    if len(words) >= 4 and len(set(words)) * 2 <= len(words) and not _STOP_WORDS & set(words):
        return 1
    if {"lorem", "ipsum"} & set(words) and not _STOP_WORDS & set(words):
        return 1
    if slots == 1:
        return 0 if told else 1 if _INSTRUCTION.search(s) else None
    return 0


# ---------------------------------------------------------------- texts as arrays
_SPACE, _LETTER, _DIGIT, _MARK, _LINE = range(5)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its class, its folded code, whether it is a capital, a small letter. What lies beyond the table is a letter."""
    n = 1 << 16
    kind, code = np.full(n, _MARK, np.uint8), np.arange(n, dtype=np.uint64)
    upper, lower = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(n):
        c = chr(i)
        if c in "\n\r\v\f\x85  ":
            kind[i] = _LINE
        elif c.isspace():
            kind[i] = _SPACE
        elif c.isalpha() or 0x300 <= i < 0x370:
            kind[i] = _LETTER
            upper[i], lower[i] = c.isupper(), c.islower()
            low = c.lower()[0]
            code[i] = ord(_PLAIN.get(ord(low)) or low) if not 0x300 <= i < 0x370 else 0
        elif c.isdigit():
            kind[i], code[i] = _DIGIT, 48
    return kind, code, upper, lower


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, _INVERSE)):
            x = np.full(2 * n, np.uint64(b))
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * _TWO >> np.uint64(64 - BITS)).astype(np.int64)


def _word_hash(w: str) -> int:
    h = 0
    for i, c in enumerate(w):
        h += ord(c) * pow(_BASE, i, 1 << 64)
    return h & ((1 << 64) - 1)


_SIGNS = np.array(sorted({_word_hash(w) for w in SIGNS}), np.uint64)
_HELD_OPEN = np.array([ord(c) for c in "{<[«@_#●…"], np.uint64)
# Short forms after which a full stop ends no passage, and those after which it does before a capital.
_NEVER, _SELDOM = np.array([_word_hash(w) for w in ("bco", "cia", "sr", "sra", "dr", "dra")], np.uint64), np.array([_word_hash("ltda")], np.uint64)


@dataclass
class Cut:
    """Passages of some texts: document, range of characters, place in the document, first token, and hashed features: one array a kind for tokens
    (0 in `valid` where an n-gram would cross passages), and a few for each passage. words: tokens of letters; sign: passages
    that may be more than ordinary text (if asked for)."""

    text: str
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    place: np.ndarray
    head: np.ndarray
    tokens: list[tuple[np.ndarray, np.ndarray | None]]
    extra: np.ndarray
    words: np.ndarray
    sign: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.doc)

    def passage(self, i: int) -> str:
        return self.text[self.start[i] : self.end[i]]


def cut(texts: list[str], whole: bool = False, signs: bool = False) -> Cut:
    """Passages (sentences and lines) of texts with their features; texts without a token have none. whole takes each text as one passage."""
    kind_of, code_of, is_upper, is_lower = _tables()
    text = "\x00".join(texts) + "\x00" if texts else ""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = cp >= len(kind_of)
    at = np.where(beyond, 0x4E00, cp)
    kind, code = kind_of[at], code_of[at]
    code[beyond] = cp[beyond]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends_of = np.cumsum(sizes)
    kind[ends_of - 1] = _LINE
    n = len(cp)
    before = np.concatenate([[_LINE], kind[:-1]])
    solid = (kind == _LETTER) | (kind == _DIGIT) | (kind == _MARK)
    begins = solid & ((kind != before) | (kind == _MARK))
    start = np.flatnonzero(begins)
    empty = np.zeros(0, np.int64)
    if not len(start):
        return Cut(text, empty, empty, empty, empty, empty, [], np.zeros((0, 0), np.int64), empty, empty.astype(bool))
    after = np.concatenate([kind[1:], [_LINE]])
    stop = np.flatnonzero(solid & ((kind != after) | (kind == _MARK))) + 1
    power, inverse = _power(n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(code * power[:n], dtype=np.uint64)])
    h = (sums[stop] - sums[start]) * inverse[start]
    tk = kind[start]
    h[tk == _DIGIT] = np.uint64(48)

    # a passage ends at a line's end, and after . ! ? before a blank unless a short form stands there
    ends = kind == _LINE
    if not whole:
        dot = (cp == 46) | (cp == 33) | (cp == 63)
        stops = np.flatnonzero(dot & (after == _SPACE))
        tok = np.searchsorted(start, stops)  # the token of the mark itself
        word = np.maximum(tok - 1, 0)
        joined = (tok > 0) & (stop[word] == stops) & (tk[word] == _LETTER)
        never = joined & np.isin(h[word], _NEVER)
        single = joined & (stop[word] - start[word] == 1) & is_upper[at[start[word]]]
        seldom = (single | joined & np.isin(h[word], _SELDOM)) & is_lower[at[np.minimum(start[np.minimum(tok + 1, len(start) - 1)], n - 1)]]
        ends[stops[~(never | seldom)]] = True
    else:
        ends[:] = False
        ends[ends_of - 1] = True
    number = np.concatenate([[0], np.cumsum(ends)[:-1]])  # passages before a character
    pid = number[start]
    fresh = np.concatenate([[True], pid[1:] != pid[:-1]])
    head = np.flatnonzero(fresh)
    tail = np.concatenate([head[1:], [len(start)]])
    doc = np.searchsorted(ends_of, start[head], side="right")
    here = np.cumsum(fresh) - 1

    cap = np.concatenate([[0], np.cumsum(is_upper[at])])
    caps = cap[stop] - cap[start]
    long = stop - start
    shape = np.where(tk == _LETTER, np.where(caps == 0, 1, np.where((caps == long) & (long > 1), 2, 3)), np.where(tk == _DIGIT, 4, code[start] + np.uint64(8))).astype(np.uint64)
    same1, same2 = here[1:] == here[:-1], here[2:] == here[:-2]
    two, shape2 = h[:-1] * _ONE + h[1:], shape[:-1] * _TWO + shape[1:] + np.uint64(1 << 40)
    three, shape3 = two[:-1] * _ONE + h[2:], shape2[:-1] * _TWO + shape[2:] + np.uint64(1 << 41)
    pad = lambda x, k: np.concatenate([x, np.zeros(k, x.dtype)])
    tokens = [
        (_bucket(h * _ONE), None), (pad(_bucket(two), 1), pad(same1, 1)), (pad(_bucket(three), 2)[: len(h)], pad(same2, 2)[: len(h)]),
        (pad(_bucket(shape2 * _ONE), 1), pad(same1, 1)), (pad(_bucket(shape3 * _ONE), 2)[: len(h)], pad(same2, 2)[: len(h)]),
    ]

    count = tail - head
    letters = np.concatenate([[0], np.cumsum(np.where(tk == _LETTER, long, 0))])
    capitals = np.concatenate([[0], np.cumsum(caps)])
    n_letters = letters[tail] - letters[head]
    shout = (n_letters > 4) & (capitals[tail] - capitals[head] == n_letters)
    again = np.zeros(len(h), np.int64)
    again[1:] += (h[1:] == h[:-1]) & same1 & (tk[1:] == _LETTER)
    again[2:] += (h[2:] == h[:-2]) & same2 & (tk[2:] == _LETTER)
    again = np.concatenate([[0], np.cumsum(again > 0)])
    repeats = (again[tail] - again[head]) * 3 >= count
    size = np.minimum(np.floor(np.log2(count)), 7)
    last = shape[tail - 1]
    parts = [size + 100, shout + 220, repeats + 230, last + np.uint64(1000)]
    extra = np.stack([_bucket(np.asarray(p).astype(np.uint64) * _ONE + np.uint64(1 << 42)) for p in parts], axis=1)
    found = Cut(text, doc, start[head], stop[tail - 1], start[head] - (ends_of - sizes)[doc], head, tokens, extra, tk == _LETTER)
    if signs:
        mark = tk == _MARK
        glued = mark & (np.concatenate([start[1:] == stop[:-1], [False]])) & np.concatenate([tk[1:] != _DIGIT, [False]])
        dots = mark & (code[start] == 46)
        sign = np.isin(h, _SIGNS) | mark & np.isin(code[start], _HELD_OPEN) | glued & np.isin(code[start], np.array([36, 37], np.uint64)) | (np.concatenate([[0], np.cumsum(dots)])[np.minimum(np.arange(len(h)) + 6, len(h))] - np.concatenate([[0], np.cumsum(dots)])[:-1] >= 6)
        found.sign = (np.add.reduceat(sign.astype(np.int64), head) > 0) | repeats & (count >= 4)
    return found


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    threshold: float = THRESHOLD

    def score(self, c: Cut) -> np.ndarray:
        """Score of each passage."""
        if not len(c):
            return np.zeros(0)
        z, n = self.weights[c.extra].sum(axis=1), np.full(len(c), c.extra.shape[1])
        for idx, valid in c.tokens:
            w = self.weights[idx]
            z += np.add.reduceat(w if valid is None else np.where(valid, w, 0), c.head)
            n = n + (np.diff(np.append(c.head, len(idx))) if valid is None else np.add.reduceat(valid.astype(np.int64), c.head))
        return _sigmoid(z, n, self.bias)


def _sigmoid(z: np.ndarray, n: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z / np.sqrt(n) * 3 + bias, -30, 30)))


def rows_of(c: Cut, unseen: np.ndarray | None = None, rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages one after another, number of each passage's features); what has an unseen token gets features at random."""
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.diff(np.append(c.head, len(c.words)))
    owner = np.repeat(np.arange(len(c)), size)
    idx, who = [c.extra.ravel()], [np.repeat(np.arange(len(c)), c.extra.shape[1])]
    for k, (i, valid) in enumerate(c.tokens):
        keep = np.ones(len(i), bool) if valid is None else valid
        if unseen is not None and k < 3:
            gone = unseen.copy()
            for shift in range(1, k + 1):
                gone[:-shift] |= unseen[shift:]
            i = np.where(gone, rng.integers(0, FEATURES, len(i)), i)
        idx.append(i[keep])
        who.append(owner[keep])
    who = np.concatenate(who)
    return np.concatenate(idx)[np.argsort(who, kind="stable")].astype(np.int32), np.bincount(who, minlength=len(c))


def train(idx: np.ndarray, n: np.ndarray, labels: np.ndarray, seed: int = SEED) -> Model:
    """Logistic regression with L2 penalty by adaptive gradient steps, from the classes' log odds as intercept; the intercept isn't
    penalised and learns at the features' rate. The rarer class weighs more, by the root of its rareness."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(FEATURES), np.full(FEATURES, 1e-2)
    if not len(labels):
        return Model(w, -10.0)
    y = labels.astype(float)
    share = min(max(y.mean(), 1e-4), 1 - 1e-4)
    bias, b2 = float(np.log(share / (1 - share))), 1e-2
    weight = np.where(y > 0, np.sqrt((1 - share) / share), 1.0)
    start = np.cumsum(n) - n
    for _ in range(PASSES):
        for part in np.array_split(rng.permutation(len(n)), max(1, len(n) // 256)):
            k = n[part]
            pos = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
            i = idx[np.repeat(start[part], k) + pos]
            z = np.add.reduceat(w[i], np.cumsum(k) - k)
            err = (_sigmoid(z, k, bias) - y[part]) * weight[part]
            seen, where = np.unique(i, return_inverse=True)
            grad = np.bincount(where, np.repeat(err / np.sqrt(k) * 3, k), len(seen)) / len(part) + PENALTY * w[seen]
            g2[seen] += grad**2
            w[seen] -= STEP * grad / np.sqrt(g2[seen])
            slope = err.mean()
            b2 += slope**2
            bias -= STEP * slope / np.sqrt(b2)
    return Model(w, bias)


# ---------------------------------------------------------------- documents
def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(documents, texts) of about CHUNK characters; a longer text is cut between passages."""
    docs, parts, size = [], [], 0
    for d, t in enumerate(texts):
        t = t or ""
        lo = 0
        while lo < len(t) or lo == 0:
            hi = len(t)
            if hi - lo > 2 * CHUNK:
                cuts = [x for x in (t.rfind("\n", lo + 1, lo + CHUNK), t.find("\n", lo + CHUNK), t.find(". ", lo + CHUNK) + 1) if x > lo]
                hi = cuts[0] + 1 if cuts else hi
            docs.append(d)
            parts.append(t[lo:hi])
            size += hi - lo
            lo = max(hi, 1)
            if size > CHUNK:
                yield docs, parts
                docs, parts, size = [], [], 0
    if docs:
        yield docs, parts


def _passages(texts: list[str | None], signs: bool = False) -> Iterator[tuple[Cut, np.ndarray]]:
    """(passages, document of each) of all texts."""
    for docs, parts in _slices(texts):
        c = cut(parts, signs=signs)
        yield c, np.asarray(docs)[c.doc] if len(c) else c.doc


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        hosts, ids, texts = b["host"].tolist(), b["doc_id"].tolist(), b["text"].tolist()
        out = []
        for c, doc in _passages(texts, signs=True):
            chosen = [zlib.crc32(f"{ids[d]}/{i}".encode()) % 10_000 < ORDINARY_SHARE * 10_000 for d, i in zip(doc.tolist(), c.place.tolist())]
            for i in np.flatnonzero(c.sign | np.array(chosen, bool)).tolist():
                p = c.passage(i)
                y = weak_label(p) if c.sign[i] else 0
                if y is not None:
                    out.append((hosts[doc[i]], p, y))
        yield pd.DataFrame(out, columns=["host", "p", "y"])


def sample(documents: DataFrame, host: str = "rut_compania") -> pd.DataFrame:
    """Weakly labelled passages of about SAMPLE_DOCUMENTS documents chosen by hash, SAMPLE_PASSAGES at most, those of least hash; the bound of the training set."""
    ship(documents.sparkSession)
    n = documents.count()
    keep = documents.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text", "doc_id")
    if n > SAMPLE_DOCUMENTS:
        keep = keep.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * SAMPLE_DOCUMENTS / n))
    got = spread(keep).mapInPandas(_labelled, "host string, p string, y int")
    got = got.orderBy(F.xxhash64("host", "p", F.lit(SEED))).limit(SAMPLE_PASSAGES)
    return got.toPandas().sort_values(["host", "p", "y"], kind="stable", ignore_index=True)


def _unseen(host: str) -> bool:
    return zlib.crc32(host.encode()) % 100 < 100 * HELD_OUT


def _wholes(texts: list[str]) -> Iterator[Cut]:
    """Texts as one passage each, WHOLES at a time."""
    for i in range(0, len(texts), WHOLES):
        yield cut(texts[i : i + WHOLES], whole=True)


def _examples(s: pd.DataFrame, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and labels of the passages, and of copies whose words are unseen and which are ordinary: what a model doesn't know is no residue.

    An ordinary passage is copied as it is and cut to a random length; of a residue passage without a place held open a copy
    keeps a quarter of its words, so that a word alone, or a sentence's form, tells nothing."""
    rng = np.random.default_rng(seed)
    ps, y = s["p"].tolist(), s["y"].to_numpy()
    parts, labels, at = [], [], 0
    for c in _wholes(ps):
        parts.append(rows_of(c))
        labels.append(y[c.doc + at])
        at += WHOLES
    plain = [p for p, k in zip(ps, y) if not k]
    short = [" ".join(p.split()[: int(rng.integers(2, 16))]).rstrip(".,;:") + "." for p in plain]
    for texts, share in ((plain, UNSEEN), (short, UNSEEN), ([p for p, k in zip(ps, y) if k and not _SLOTS.search(p)], MOSTLY)):
        for c in _wholes(texts):
            parts.append(rows_of(c, c.words & (rng.random(len(c.words)) < share), rng))
            labels.append(np.zeros(len(c), y.dtype))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate(labels)


def fitted(documents: DataFrame, host: str = "rut_compania") -> tuple[Model, pd.DataFrame]:
    """The model and its sample with `held` and, of held hosts, `puntaje`. Trained on the other hosts; the threshold is the middle
    of those that agree best with the labels of the held ones, THRESHOLD at least."""
    s = sample(documents, host)
    s = s.assign(held=s["host"].map(_unseen).astype(bool) if len(s) else False, puntaje=np.nan)
    use = s[~s["held"]]
    model = train(*_examples(use, SEED)) if len(use) else train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    held = s[s["held"]]
    if len(held) and held["y"].any():
        z = np.zeros(len(held))
        for i, c in enumerate(_wholes(held["p"].tolist())):
            z[c.doc + i * WHOLES] = model.score(c)
        s.loc[s["held"], "puntaje"] = z
        y = held["y"].to_numpy() == 1
        grid = np.linspace(THRESHOLD, 0.95, 46)
        f1 = np.array([2 * ((z >= t) & y).sum() / max(1, (z >= t).sum() + y.sum()) for t in grid])
        model.threshold = float(np.median(grid[f1 >= f1.max() - 1e-9]))
    return model, s


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, puntaje, pasaje): each document's highest passage score and that passage. Null and empty texts score 0."""
    spark = documents.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))  # FEATURES numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*sent.value)
        for b in batches:
            top, which = np.zeros(len(b)), [None] * len(b)
            for c, doc in _passages(b["text"].tolist()):
                if not len(c):
                    continue
                z = m.score(c)
                best = np.lexsort((-z, doc))
                best = best[np.concatenate([[True], doc[best][1:] != doc[best][:-1]])]
                for i in best.tolist():
                    if z[i] > top[doc[i]]:
                        top[doc[i]], which[doc[i]] = z[i], c.passage(i)
            yield pd.DataFrame({"doc_id": b["doc_id"], "puntaje": top, "pasaje": which})

    return spread(documents.select("doc_id", "text")).mapInPandas(run, "doc_id long, puntaje double, pasaje string")


def residue(documents: DataFrame, host: str = "rut_compania") -> DataFrame:
    """scored rows of the documents that are, or hold a passage of, residue. Without any labelled passage none is found."""
    model, _ = fitted(documents, host)
    return scored(documents, model).where(F.col("puntaje") >= model.threshold)


def validation(documents: DataFrame, host: str = "rut_compania") -> DataFrame:
    """(anfitriones, pasajes, umbral, precision, recuerdo): agreement of the very model used with the weak labels on hosts held out of its training."""
    model, s = fitted(documents, host)
    held = s[s["held"]]
    z, y = held["puntaje"].to_numpy() >= model.threshold, held["y"].to_numpy() == 1
    hit = int((z & y).sum())
    row = (int(held["host"].nunique()), len(held), model.threshold, hit / max(1, int(z.sum())), hit / max(1, int(y.sum())))
    return documents.sparkSession.createDataFrame([row], "anfitriones long, pasajes long, umbral double, precision double, recuerdo double")
