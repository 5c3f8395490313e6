"""Garbled text from wrong character encodings.

For every pair of encodings, and for texts that went through such a pair twice or three times, the sequence
that each letter turns into is computed beforehand. One multi-pattern automaton finds those sequences, longest
first, and only the matched spans are replaced, so correct text beside them stays as it is. Sequences of two
and more characters are evidence by themselves; a single wrong character must also stand where its letter would
and the character itself would not.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.session import ship

# Encodings that texts are written in and misread as.
WRONG = ("latin_1", "cp1252", "cp850", "cp437", "mac_roman", "cp1251")
SINGLE = ("cp1252", "mac_roman", "cp850", "cp437", "cp1251")
#: How often a text may have been misread, one time on another.
DEPTH = 3
# Letters of the texts' languages (Spanish, Portuguese, German, French).
LOWER = "áéíóúüñçãõàâêôßäöèëïîûùœæåø"
LETTERS = LOWER + LOWER.replace("ß", "").upper() + "ªº"
#: Letters that single-character repair may restore, the most frequent first, and letters that stand rightly in a text.
LIKELY = "áéíóúñüÁÉÍÓÚÑÜãçõÃÇÕêâôàÊÂÔÀß"
RIGHTFUL = set("áéíóúüñçãõàâêôäöèßªº" + "ÁÉÍÓÚÜÑÇÃÕÀÂÊÔÄÖÈ")
PUNCTUATION = "‘’“”–—…€¡¿«»°·"
BROKEN = "�"
#: Fixed width of the name field, at which a garbled sequence may be cut.
CUT_AT = 60


def _misread(s: str, wrong: str) -> str | None:
    """UTF-8 bytes of s read as another encoding; bytes without a character keep their control code."""
    try:
        return "".join(bytes([b]).decode(wrong) if wrong not in ("cp1252", "cp1251") else _lenient(b, wrong) for b in s.encode("utf-8"))
    except UnicodeError:
        return None


def _lenient(b: int, enc: str) -> str:
    try:
        return bytes([b]).decode(enc)
    except UnicodeDecodeError:
        return chr(b)


@lru_cache(1)
def sequences() -> dict[str, str]:
    """Garbled sequence of two or more characters -> the character it was."""
    out: dict[str, str] = {}
    for ch in LETTERS + PUNCTUATION:
        layer = {ch}
        for _ in range(DEPTH):
            layer = {g for s in layer for w in WRONG if (g := _misread(s, w)) and len(g) > 1}
            for g in layer:
                out.setdefault(g, ch)
    return out


@lru_cache(1)
def pairs() -> list[dict[str, str]]:
    """For each pair of single-byte encodings: wrong character -> letter."""
    out = []
    for true in SINGLE:
        for wrong in SINGLE:
            own: dict[str, str] = {}
            for ch in LIKELY:
                try:
                    g = _lenient(ch.encode(true)[0], wrong)
                except UnicodeEncodeError:
                    continue
                if g != ch and not g.isascii():
                    own.setdefault(g, ch)
            if own:
                out.append(own)
    return out


@lru_cache(1)
def singles() -> set[str]:
    return {g for own in pairs() for g in own}


@lru_cache(1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for g, ch in sequences().items():
        a.add_word(g, (len(g), ch))
    for g in singles():
        if not a.exists(g):
            a.add_word(g, (1, None))
    a.make_automaton()
    return a


@lru_cache(1)
def _prefixes() -> set[str]:
    return {g[:i] for g in sequences() for i in range(1, len(g))}


def _ranked(s: str) -> list[dict[str, str]]:
    """Pairs of encodings, those first that explain most of the text's characters beyond ASCII that can be wrong."""
    odd = {c for c in s if not c.isascii() and c not in RIGHTFUL}
    return sorted(pairs(), key=lambda own: -sum(c in own for c in odd))


def _fits(s: str, i: int, ranked: list[dict[str, str]]) -> str | None:
    """The letter that the single character at i stands for, or None if it stands there rightly."""
    ch = s[i]
    before, after = s[i - 1 : i], s[i + 1 : i + 2]
    left, right = (bool(c) and (c.isalpha() or not c.isascii() and c in singles()) for c in (before, after))
    if not left and not right:
        return None
    word = re.split(r"[^\w]", s[:i])[-1] + re.split(r"[^\w]", s[i + 1 :])[0]
    ascii_word = "".join(c for c in word if c.isascii() and c.isalpha())
    if not ascii_word:
        return None
    upper = ascii_word.isupper() and len(ascii_word) > 1
    lower = (ascii_word[1:] if left and len(ascii_word) > 1 else ascii_word).islower() or ascii_word[:1].isupper() and ascii_word[1:].islower()
    if ch.isalpha() and ch in RIGHTFUL:
        if ch in "ªº":  # ordinal marks follow M, D and digits and end a word
            if not right:
                return None
        elif ch == "ß":
            if left and before.lower() in "aeiouäöü" and (not right or after.lower() in "aeiouhtlks"):
                return None
        elif ch in "õÕ" and after.lower() == "e" or ch in "ãÃ" and (not right or after.lower() in "oesn"):
            return None
        elif ch not in "õÕãÃ" and not (ch.isupper() and left and before.islower()) and not (ch.islower() and upper):
            return None
    elif not ch.isalpha():
        if not (left and right):
            opened = ch in "”’»" and any(q in s[:i] for q in "“‘«") or ch in "“‘«"
            if opened or ch in "°" and s[i - 1 : i].isdigit() or ch == "–" and not left:
                return None
        if ch in "·’" and left and right and ch == "’":
            return None
    for own in ranked:
        c = own.get(ch)
        if c and (c.isupper() == upper or (not left and c.isupper() and lower)):
            return c
    return None


def repair(s: str) -> tuple[bool, str, bool]:
    """(affected, text, whole): whole is False if some of it is beyond repair.

    The empty text is not affected. Letters written as base and accent, missing accents and foreign letters used
    rightly are not garbled. A text of any length takes time in proportion to it."""
    if s.isascii():
        return False, s, True
    affected, whole = False, True
    hits = list(_automaton().iter_long(s))
    if hits:
        out, at, ranked = [], 0, _ranked(s)
        for end, (n, ch) in hits:
            start = end - n + 1
            if n == 1:
                ch = _fits(s, start, ranked) if ch is None else ch
                if ch is None:
                    continue
            out += [s[at:start], ch]
            at, affected = end + 1, True
        s0, s = s, "".join(out) + s[at:]
        if affected and s != s0:
            again = repair(s)
            s, whole = again[1], again[2]
    tail = next((n for n in range(min(8, len(s)), 0, -1) if s[-n:] in _prefixes()), 0)
    if tail and (tail > 1 or not s[-1].isalpha() and s[-1] not in PUNCTUATION) and (len(s) > tail and s[-tail - 1].isalpha() or s[-tail] in "Ã├√Г" and len(s) >= CUT_AT - 8):
        affected, whole, s = True, False, s[:-tail]
    if BROKEN in s or any(unicodedata.category(c) == "Cc" and ord(c) >= 0x80 for c in s):
        affected, whole = True, False
    return affected, s, whole


RESULT = T.StructType([T.StructField("afectado", T.BooleanType()), T.StructField("texto", T.StringType()), T.StructField("entero", T.BooleanType())])


@F.pandas_udf(RESULT)
def repaired(texts: pd.Series) -> pd.DataFrame:
    """repair of a column; a null gives nulls."""
    rows = [(None, None, None) if t is None else repair(t) for t in texts]
    return pd.DataFrame(rows, columns=["afectado", "texto", "entero"], index=texts.index).astype(object)


def with_repair(rows: DataFrame, column: str | Column) -> DataFrame:
    """rows with `_r` (afectado, texto, entero). No shuffle; texts that are ASCII cost one test."""
    ship(rows.sparkSession)
    return rows.withColumn("_r", repaired(F.col(column) if isinstance(column, str) else column))


def garbled_names(names: DataFrame, parties: DataFrame) -> DataFrame:
    """(tabla, clave, texto, reparado, entero) of each affected row of both tables; repeated rows once. Null names aren't affected."""
    a = names.select(F.lit("cmf_v2024").alias("tabla"), F.col("registro_id").cast("string").alias("clave"), F.col("nombre").alias("texto"))
    b = parties.select(F.lit("contrapartes").alias("tabla"), F.col("entidad_id").cast("string").alias("clave"), F.col("entidad_nombre").alias("texto"))
    # ASCII is never affected, so it doesn't leave the JVM
    got = with_repair(a.unionByName(b).where(F.col("texto").rlike(r"[^\x00-\x7F]")), "texto").where("_r.afectado")
    return got.select("tabla", "clave", "texto", F.col("_r.texto").alias("reparado"), F.col("_r.entero").alias("entero")).distinct()
