"""Quantities recorded in different units.

The distinct spellings of units, in unit columns, in text amounts and in remarks, are cut into words. A character
n-gram inverted index over the known words proposes meanings for each distinct word, a weighted edit distance verifies
them, and near ties between different meanings are refused. A spelling's scale and currency are put together from its
words, so spellings that no list holds are read too; those that can't be read are reported. The resulting alias
dictionary is joined to all rows. Rows that state no unit get that of their file if the file as a whole plainly isn't
in the norm's unit.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.session import checkpointed, counted_small, ship

NORM = "MCLP"
# Words of currencies and of scales (powers of ten), words that say nothing, and words that deny what follows.
CURRENCIES: dict[str, list[str]] = {
    "CLP": ["$", "clp", "peso", "pesos"],
    "USD": ["usd", "us$", "u$s", "u$d", "dolar", "dolares", "dollar", "dollars"],
    "UF": ["uf", "ufs", "fomento"],
}
SCALES: dict[int, list[str]] = {
    0: ["unid", "unidad", "unidades", "unit", "units", "single", "entero", "enteros"],
    3: ["m", "k", "mil", "miles", "thousand", "thousands"],
    6: ["mm", "mill", "millon", "millones", "million", "millions"],
    9: ["mmm", "billion", "billions"],
}
SILENT = ("de", "del", "en", "of", "in", "la", "los", "chileno", "chilenos", "chilean", "americano", "americanos", "american", "us")
DENIAL = ("no", "not", "sin", "falta", "without", "ni", "nunca")
#: Words that say that a remark is about the amount itself.
AMOUNT_WORDS = (
    "monto", "montos", "cifra", "cifras", "valor", "valores", "importe", "importes", "cantidad", "cantidades", "amount", "amounts", "value", "values", "figure", "figures",
    "expresado", "expresados", "reported", "stated", "expressed",
)
#: Prefix of a unit's name by its power of ten.
PREFIX = {0: "", 3: "M", 6: "MM", 9: "MMM"}
#: Short forms that join scale and currency in one word are made of these.
FUSED_SCALES, FUSED_CURRENCIES = {"m": 3, "k": 3, "mm": 6, "mmm": 9}, {"clp": "CLP", "usd": "USD", "uf": "UF"}
#: Length of the grams of the inverted index, the edit cost per character of the known word below which a typo counts, and the lead it needs over another meaning.
GRAM, MAX_COST, LEAD = 2, 0.2, 0.1
#: Least letters of a known word for which typos count.
LEAST_FUZZY = 4
#: Orders of magnitude between a file's mean amount and the norm's from which the file plainly differs, and the share of its lines with the other unit's shape.
FILE_STEP, FILE_SHARE = 1.5, 0.8

# Accented letters.
_ACCENTED, _PLAIN = "áàâãäéèêëíìîïóòôõöúùûüñç", "aaaaaeeeeiiiiooooouuuunc"


def folded(c: Column) -> Column:
    """Lower case, no accents, numbers as 9, single blanks, abbreviations of letters (u.f.) as one word."""
    t = F.regexp_replace(F.translate(F.lower(c), _ACCENTED, _PLAIN), "[\\u0300-\\u036f]", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\d+", "9"), r"(?<=\b[a-z])\.(?=[a-z]\b)", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def words_of(c: Column) -> Column:
    """Words, currency signs and the marks that divide a remark, of a folded text."""
    return F.regexp_extract_all(c, F.lit(r"(us\$|u\$[sd]|\$|[a-z]+|[(),;:])"), F.lit(1))


#: Characters that an edit may add or drop cheaply.
LIGHT = " .,;:()-_'/"


def edit_cost(a: str, b: str) -> float:
    """Weighted edit distance: letters, digits and $ cost 1, punctuation and blanks 0.3, a swap of neighbours 0.7."""
    w = lambda c: 0.3 if c in LIGHT else 1.0
    before2: list[float] = []
    before = [0.0]
    for c in b:
        before.append(before[-1] + w(c))
    for i, x in enumerate(a, 1):
        row = [before[0] + w(x)]
        for j, y in enumerate(b, 1):
            best = min(before[j] + w(x), row[-1] + w(y), before[j - 1] + (0.0 if x == y else max(w(x), w(y))))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before2[j - 2] + 0.7)
            row.append(best)
        before2, before = before, row
    return before[-1]


def meanings() -> dict[str, str]:
    """Meaning of each known word: `exponent|currency`, one of them empty for a word of one kind; '' for a silent one."""
    out = {w: f"|{c}" for c, ws in CURRENCIES.items() for w in ws} | {w: f"{e}|" for e, ws in SCALES.items() for w in ws}
    out |= {w: "" for w in SILENT}
    for s, e in FUSED_SCALES.items():
        for c, cur in FUSED_CURRENCIES.items():
            out[s + c] = out[c + s] = f"{e}|{cur}"
    return out


def _grams(c: Column) -> Column:
    s = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - GRAM + 1), lambda i: F.substring(s, i, GRAM)))


def word_meanings(words: DataFrame) -> DataFrame:
    """(w, m): meaning of each distinct word that is known, or a typo of known words of one meaning. Unknown words have no row.

    Candidates share grams with a known word through the inverted index; a cost below MAX_COST a character counts, and one of
    another meaning within LEAD of it refuses the word. The known words are a fixed list, so the index is a small broadcast."""
    spark = words.sparkSession
    known = spark.createDataFrame(sorted(meanings().items()), "_known string, m string")
    exact = words.join(F.broadcast(known), F.col("w") == F.col("_known")).select("w", "m")
    index = known.where(F.length("_known") >= LEAST_FUZZY).withColumn("_g", F.explode(_grams(F.col("_known"))))
    # a typo changes few letters, so a word of another length has no candidates
    rest = words.where(F.length("w").between(LEAST_FUZZY - 1, 30)).join(F.broadcast(known), F.col("w") == F.col("_known"), "left_anti").withColumn("_g", F.explode(_grams(F.col("w"))))
    cand = rest.join(F.broadcast(index), "_g").where(F.abs(F.length("w") - F.length("_known")) <= F.length("_known") * MAX_COST).groupBy("w", "_known", "m").agg(F.count(F.lit(1)).alias("_shared"))

    @F.pandas_udf(T.DoubleType())
    def cost(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([edit_cost(x, y) / len(y) for x, y in zip(a, b)], dtype="float64")

    cand = cand.where("_shared >= 2").withColumn("c", cost("w", "_known")).where(F.col("c") < MAX_COST + LEAD)
    best = cand.groupBy("w", "m").agg(F.min("c").alias("c")).groupBy("w").agg(F.slice(F.array_sort(F.collect_list(F.struct("c", "m"))), 1, 2).alias("b"))  # meanings are few
    clear = (F.size("b") == 1) | (F.get("b", F.lit(1))["c"] - F.get("b", F.lit(0))["c"] >= LEAD)
    return exact.unionByName(best.where((F.get("b", F.lit(0))["c"] < MAX_COST) & clear).select("w", F.get("b", F.lit(0))["m"].alias("m")))


def compose(kind: str, words: list[str], found: list[str | None]) -> str | None:
    """Unit of a spelling from its words and their meanings (null: unknown word).

    A unit spelling must be known word by word; a remark must speak of the amount in its first words, and what follows a
    denial up to the next mark doesn't count. Two currencies or two scales are a contradiction, except thousands of millions.
    Without a currency a scale is one of pesos. null: not to be read; '' for a remark that states none."""
    none = "" if kind == "remark" else None
    if kind == "remark" and not set([w for w in words if w.isalpha()][:4]) & set(AMOUNT_WORDS):
        return none
    scales, currencies, denied = [], [], False
    for i, (w, m) in enumerate(zip(words, found)):
        if w in "(),;:":
            denied = False
            continue
        if kind == "remark" and w in DENIAL:
            denied = True
        if denied or m == "":
            continue
        if m is None:
            if kind == "unit":
                return None
            continue
        scale, currency = m.split("|")
        if w in ("m", "k"):  # a letter alone is a scale only beside a currency
            near = [found[j] for j in range(max(0, i - 2), min(len(words), i + 3)) if j != i and words[j] not in SILENT]
            if not any(x and x.split("|")[1] for x in near):
                if kind == "unit":
                    return None
                continue
        if scale:
            scales.append(int(scale))
        if currency:
            currencies.append(currency)
    size = [s for s in scales if s]
    if size == [3, 6]:
        size = [9]
    if len(set(size)) > 1 or len(set(currencies)) > 1 or not (size or currencies):
        return none
    return PREFIX[size[0] if size else 0] + (currencies[0] if currencies else "CLP")


def alias_dictionary(spellings: DataFrame) -> DataFrame:
    """(tipo, grafia, unidad) of distinct (tipo, grafia), grafia being folded: tipo is unit or remark.

    unidad is '' if a remark states none, null if a unit spelling can't be read. Words are looked up once each, however
    many spellings have them."""
    spark = spellings.sparkSession
    ship(spark)
    own = spellings.select("tipo", "grafia").distinct().withColumn("_ws", words_of(F.col("grafia")))
    long = checkpointed(own.select("tipo", "grafia", F.posexplode("_ws").alias("i", "w")))
    known = word_meanings(long.select("w").distinct())
    read = long.join(known, "w", "left").groupBy("tipo", "grafia").agg(F.array_sort(F.collect_list(F.struct("i", "w", "m"))).alias("_x"))

    @F.pandas_udf(T.StringType())
    def unit(kind: pd.Series, ws: pd.Series, ms: pd.Series) -> pd.Series:
        return pd.Series([compose(k, list(w), list(m)) for k, w, m in zip(kind, ws, ms)], dtype=object)

    got = read.withColumn("unidad", unit("tipo", F.transform("_x", lambda x: x["w"]), F.transform("_x", lambda x: x["m"]))).select("tipo", "grafia", "unidad")
    empty = own.where(F.size("_ws") == 0).select("tipo", "grafia", F.when(F.col("tipo") == "remark", "").alias("unidad"))
    return got.unionByName(empty)


_NUMBER = r"\d[\d.,]*\d|\d"


def spelled_unit(text: Column) -> Column:
    """A text amount without its number."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, _NUMBER, " "), r"\.-|\s+", " "))


def spelled_number(text: Column) -> Column:
    """The number of a text amount, in Spanish (1.234,5) or English (1,234.5) notation.

    Of two different marks the last is the decimal one; a mark that repeats, or that three digits follow,
    divides thousands; the exceptions are the unit's own: after `k` or `mm` at the end a point is decimal,
    and a lone comma is decimal in Spanish spellings. Null if there is no number."""
    n = F.regexp_extract(text, f"({_NUMBER})", 1)
    english = text.rlike(r"(?i)(?:\d\s*k|\bmm)\s*$")
    dot, comma = F.instr(F.reverse(n), "."), F.instr(F.reverse(n), ",")
    as_spanish = F.replace(F.replace(n, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    as_english = F.replace(n, F.lit(","), F.lit(""))
    lone_point = n.rlike(r"^\d+\.\d{1,2}$|^\d+\.\d{4,}$|^0\.\d+$")
    many_commas = n.rlike(r"^\d{1,3}(?:,\d{3}){2,}$")
    picked = (
        F.when((dot > 0) & (comma > 0), F.when(dot < comma, as_english).otherwise(as_spanish))
        .when(english | lone_point | many_commas, as_english).otherwise(as_spanish)
    )
    return picked.try_cast("double")


def stacked(derivatives: DataFrame, bonds: DataFrame) -> DataFrame:
    """The amounts of both tables in one shape; repeated rows fall together later, by their natural key."""
    key = ["zip_origen", "source_file", "line_no"]
    a = derivatives.select(F.lit("fact_derivado").alias("tabla"), "periodo_informacion", *key, F.col("nocional_m").alias("monto"), F.col("unidad_monto").alias("unidad_col"), F.col("nocional_texto").alias("texto"), "glosa")
    b = bonds.select(F.lit("v_renta_fija_clasificada").alias("tabla"), "periodo_informacion", *key, F.col("valor_final").alias("monto"), F.col("unidad_valor").alias("unidad_col"), F.col("valor_texto").alias("texto"), "glosa")
    return a.unionByName(b)


def _spelled(rows: DataFrame) -> DataFrame:
    """Rows with an amount, their number, and the folded spelling that may tell its unit: `_g` of the kind `_t`."""
    has_text = F.col("monto").isNull() & F.col("texto").isNotNull()
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    unit = folded(F.coalesce(F.when(has_text, blank(spelled_unit(F.col("texto")))), blank(F.col("unidad_col"))))
    rows = rows.withColumn("_u", unit).withColumn("monto", F.when(has_text, spelled_number(F.col("texto"))).otherwise(F.col("monto")))
    rows = rows.where(F.col("monto").isNotNull() & ~F.isnan("monto")).withColumn("_g", F.coalesce("_u", blank(folded(F.col("glosa")))))
    return rows.withColumn("_t", F.when(F.col("_u").isNotNull(), "unit").when(F.col("_g").isNotNull(), "remark")).drop("_u")


def with_units(rows: DataFrame) -> DataFrame:
    """rows (see stacked) with `unidad` and `origen_unidad`: unit, remark, file, norm or unknown. Rows without an amount are left out.

    A unit column or the text of the amount goes before the remark. A unit spelling that can't be read has no unit (null) and
    origin `unknown`: nothing is assumed of it. Null amounts, NaN and texts without a number are no amounts. Empty tables give
    no rows. One pass over the rows gathers the spellings and the statistics of files, another joins the results."""
    spelled = _spelled(rows)
    live = F.col("monto") != 0
    ones = lambda c: F.sum(F.when(live, c.cast("double")))
    m = F.col("monto")
    parts = spelled.groupBy("tabla", "zip_origen", "source_file", "_t", "_g").agg(
        F.count(F.when(live, 1)).alias("_n"), ones(F.log10(F.abs("monto"))).alias("_size"), ones(m % 1000 == 0).alias("_thousands"), ones(m % 1 != 0).alias("_broken"),
        ones(F.abs(m * 100 - F.round(m * 100)) < 1e-4).alias("_cents"),
    )
    parts = checkpointed(parts)
    dictionary = checkpointed(alias_dictionary(parts.where("_t IS NOT NULL").select(F.col("_t").alias("tipo"), F.col("_g").alias("grafia"))))
    stated = dictionary.where("tipo = 'unit' OR unidad <> ''").select(F.col("tipo").alias("_t"), F.col("grafia").alias("_g"), F.coalesce("unidad", F.lit("?")).alias("_stated"))
    stated = counted_small(stated, written=True)

    got = parts.join(stated, ["_t", "_g"], "left")
    is_norm, unstated = F.col("_stated") == NORM, F.col("_stated").isNull()
    part = lambda keep, c: F.sum(F.when(keep, F.col(c)))
    files = got.groupBy("tabla", "zip_origen", "source_file").agg(
        part(unstated, "_n").alias("_n"), *[F.try_divide(part(unstated, c), part(unstated, "_n")).alias(c) for c in ("_size", "_thousands", "_broken", "_cents")],
        part(is_norm, "_size").alias("_norm_sum"), part(is_norm, "_n").alias("_norm_n"),
    )
    files = checkpointed(files)
    level = F.broadcast(files.groupBy("tabla").agg(F.try_divide(F.sum("_norm_sum"), F.sum("_norm_n")).alias("_norm")))  # one row a table
    off = F.col("_size") - F.col("_norm")
    cents = (F.col("_cents") >= 0.95) & (F.col("_n") >= 5) & (F.col("_broken") >= FILE_SHARE)
    file_unit = (
        F.when((off >= FILE_STEP) & (F.col("_thousands") >= FILE_SHARE), "CLP")
        .when(cents & off.between(-2.2, -1.0), "UF").when(cents & (off < -2.2), "MUSD")
        .when((off <= -FILE_STEP) & (F.col("_broken") >= FILE_SHARE), "MMCLP")
    )
    odd = files.where("_n > 0").join(level, "tabla").withColumn("_f", file_unit).where("_f IS NOT NULL").select("tabla", "zip_origen", "source_file", "_f")
    out = spelled.join(stated, ["_t", "_g"], "left").join(counted_small(odd, written=True), ["tabla", "zip_origen", "source_file"], "left")
    unknown = F.col("_stated") == "?"
    unit = F.when(~F.coalesce(unknown, F.lit(False)), F.coalesce("_stated", "_f", F.lit(NORM)))
    origin = F.when(unknown, "unknown").when(F.col("_stated").isNotNull(), F.col("_t")).when(F.col("_f").isNotNull(), "file").otherwise("norm")
    return out.withColumn("unidad", unit).withColumn("origen_unidad", origin).drop("_t", "_g", "_stated", "_f")


def in_norm_units(rows: DataFrame, closes: DataFrame) -> DataFrame:
    """rows of with_units with `monto_norma`: the amount in thousands of pesos, at the close of its period.

    closes: serie (UF, USD), periodo, valor in pesos per unit; one value a month, so a few rows a series.
    An amount without a unit, or in UF or dollars of a period without a close, is null."""
    closes = closes.groupBy(F.col("periodo").alias("periodo_informacion")).agg(
        F.max(F.when(F.upper("serie") == "UF", F.col("valor"))).alias("_uf"), F.max(F.when(F.upper("serie") == "USD", F.col("valor"))).alias("_usd")
    )
    u, m = F.col("unidad"), F.col("monto")
    price = {"CLP": F.lit(1.0), "USD": F.col("_usd"), "UF": F.col("_uf")}
    every = [(p + c, m * (10.0**e / 1000) * v if e >= 3 else m * v / 1000) for e, p in PREFIX.items() for c, v in price.items()]
    value = reduce(lambda a, x: a.when(u == x[0], x[1]), every, F.when(u == NORM, m))
    return rows.join(counted_small(closes), "periodo_informacion", "left").withColumn("monto_norma", value).drop("_uf", "_usd")
