"""Schemas that drift between files.

Each delivered file brings its own field list. Lines are loaded as path-value maps with raw types by their
file's list; path-type statistics are aggregated per file, beside what the list declares; the statistics of
consecutive periods are compared, a pair of a vanished and a new field with one picture being a rename if the
same lines hold the same values; and all lines are projected to one typed table whose column types follow from
the statistics, every cast that fails being reported in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.session import checkpointed, counted_small

#: Share of the filled values on common lines that are equal, from which a vanished and a new field are one field renamed.
RENAME_SHARE = 0.5
#: Share of filled values of a raw type from which a column gets that type.
TYPE_SHARE = 0.95

# Letters whose accents don't count in field names.
ACCENTED, PLAIN = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÑÇ", "AAAAAEEEEIIIIOOOOOUUUUNC"


def field_name(c: Column) -> Column:
    """Capitals without accents, words joined by `_`."""
    plain = F.regexp_replace(F.translate(F.upper(c), ACCENTED, PLAIN), "[\\u0300-\\u036f]", "")
    return F.regexp_replace(F.regexp_replace(plain, "[^A-Z0-9]+", "_"), "^_|_$", "")


def _places(part: Column) -> Column:
    """Characters of a picture part such as 9(13), 999 or X(02)."""
    reps = F.regexp_extract_all(part, F.lit("[9XA](?:\\(\\d+\\))?"), F.lit(0))
    return F.aggregate(reps, F.lit(0), lambda n, x: n + F.coalesce(F.regexp_extract(x, "\\((\\d+)\\)", 1).try_cast("int"), F.lit(1)))


def picture(c: Column) -> dict[str, Column]:
    """kind ('9' digits, 'X' text), signed, decimals and width (characters, the sign included) of a picture in any notation."""
    p = F.regexp_replace(F.upper(c), "\\s", "")
    body = F.regexp_replace(p, "^[-+S]", "")
    whole, part = F.split(body, "V").getItem(0), F.coalesce(F.get(F.split(body, "V"), F.lit(1)), F.lit(""))
    sign = p.rlike("^[-+S]")
    return {
        "kind": F.when(body.startswith("9"), "9").otherwise("X"),
        "signed": sign,
        "decimals": _places(part),
        "width": _places(whole) + _places(part) + sign.cast("int"),
    }


def field_lists(fields: DataFrame) -> DataFrame:
    """One row per file and field: names and pictures normalised; repeated rows fall together.

    Rows without archivo_id, pos or a name are left out; an unreadable picture has width 0. Each way of writing a field is
    read once, however many files have it."""
    written = fields.select("archivo_id", "serie_id", "letra", "periodo", "fecha_descarga", "pos", F.col("campo").alias("_c"), F.coalesce("pic", F.lit("")).alias("_p")).dropna(subset=["archivo_id", "pos", "_c"])
    ways = written.select("_c", "_p").distinct().select("_c", "_p", field_name(F.col("_c")).alias("campo"), *[x.alias(n) for n, x in picture(F.col("_p")).items()])
    return written.join(counted_small(ways), ["_c", "_p"]).drop("_c", "_p").distinct()


def layouts(lists: DataFrame) -> DataFrame:
    """One row per file: `_names`, its fields in order, and `_cuts`, where each lies. A file's fields are few and fixed by its format.

    A name that a list has twice keeps its first field."""
    one = F.array_sort(F.collect_list(F.struct("pos", "campo", "kind", "signed", "decimals", "width"))).alias("_f")
    start = lambda acc, x: F.struct((acc["at"] + x["width"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["campo"].alias("campo"), acc["at"].alias("at"), x["width"].alias("width"), x["kind"].alias("kind"), x["decimals"].alias("decimals")))).alias("out"))
    empty = F.struct(F.lit(1).alias("at"), F.expr("CAST(array() AS ARRAY<STRUCT<campo: STRING, at: INT, width: INT, kind: STRING, decimals: INT>>)").alias("out"))
    w = lists.groupBy("archivo_id").agg(one).select("archivo_id", F.aggregate("_f", empty, start)["out"].alias("_all"))
    w = w.withColumn("_every", F.transform("_all", lambda x: x["campo"]))
    w = w.withColumn("_cuts", F.filter("_all", lambda x, i: F.array_position(F.col("_every"), x["campo"]) == i + 1))
    return w.select("archivo_id", F.transform("_cuts", lambda x: x["campo"]).alias("_names"), "_cuts")


#: What a value looks like, whatever its picture says: AAAAMMDD, AAAA-MM-DD, digits, signed digits, anything else.
RAW_TYPES = ("empty", "date8", "iso", "int", "signed", "text")


def raw_type(v: Column) -> Column:
    """One of RAW_TYPES. Digits are told without a pattern; patterns only see what has a date's length."""
    t = F.trim(v)
    rest = F.translate(t, "0123456789", "")
    day = "(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])"
    iso = "(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
    return (
        F.when(t == "", "empty").when(rest == "", F.when((F.length(t) == 8) & t.rlike(f"^{day}$"), "date8").otherwise("int"))
        .when(rest.isin("-", "+") & (F.length(t) > 1) & (F.substring(t, 1, 1) == rest), "signed")
        .when((rest == "--") & (F.length(t) == 10) & t.rlike(f"^{iso}$"), "iso").otherwise("text")
    )


def path_values(lines: DataFrame, lists: DataFrame) -> DataFrame:
    """(archivo_id, line_no, valores): each line as a map from field to value, raw type and decimals, cut by its own file's list.

    A line shorter than its list has empty values at its end; lines of files without a list are left out."""
    return _cut(lines.select("archivo_id", "line_no", "raw").distinct().join(layouts(lists), "archivo_id"), "archivo_id", "line_no")


def _cut(at: DataFrame, *kept: str) -> DataFrame:
    value = lambda x: F.struct(F.substring(F.col("raw"), x["at"], x["width"]).alias("v"), x["kind"].alias("kind"), x["decimals"].alias("decimals"))
    return at.select(*kept, F.map_from_arrays("_names", F.transform("_cuts", value)).alias("valores"))


def path_statistics(values: DataFrame) -> DataFrame:
    """(archivo_id, campo, one count a raw type, largo_max): what each field of each file looks like; one aggregate, combined before its shuffle."""
    e = values.select("archivo_id", F.explode("valores").alias("campo", "c")).select("archivo_id", "campo", F.length(F.trim("c.v")).alias("_n"), raw_type(F.col("c.v")).alias("_t"))
    return e.groupBy("archivo_id", "campo").agg(*[F.count(F.when(F.col("_t") == t, 1)).alias(t) for t in RAW_TYPES], F.max("_n").alias("largo_max"))


def path_types(values: DataFrame) -> DataFrame:
    """(archivo_id, campo, tipo, filas): how often each field of each file looks like which type."""
    return path_statistics(values).unpivot(["archivo_id", "campo"], list(RAW_TYPES), "tipo", "filas").where("filas > 0")


def deliveries(lists: DataFrame) -> DataFrame:
    """(serie_id, periodo, archivo_id, antes): the last downloaded file of each period, and that of the period delivered before it.

    A null download counts as the earliest; ties go to the greater archivo_id."""
    last = lists.groupBy("serie_id", "periodo").agg(F.max(F.struct(F.coalesce("fecha_descarga", F.lit("1900-01-01").cast("date")).alias("d"), "archivo_id")).alias("_l"))
    last = last.select("serie_id", "periodo", F.col("_l.archivo_id").alias("archivo_id"))
    return last.withColumn("antes", F.lag("archivo_id").over(Window.partitionBy("serie_id").orderBy("periodo")))


_SIDES = ["archivo_id", "antes"]


def _in_both_roles(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """rows of each file once as the later and once as the earlier of a pair: `_new` tells which, archivo_id and antes name the pair."""
    role = pairs.select(F.explode(F.array(F.struct(F.col("archivo_id").alias("f"), F.lit(True).alias("n")), F.struct(F.col("antes").alias("f"), F.lit(False).alias("n")))).alias("r"), *_SIDES)
    role = role.select(F.col("r.f").alias("_file"), F.col("r.n").alias("_new"), *_SIDES)
    return rows.withColumnRenamed("archivo_id", "_file").join(role, "_file")


def renames(vanished_and_new: DataFrame, lines: DataFrame, lists: DataFrame) -> DataFrame:
    """(archivo_id, antes, campo, campo_antes) of fields renamed. vanished_and_new: archivo_id, antes, p, nuevos, viejos, the names of one picture.

    Values are compared line by line and only where filled; no common line, or nothing filled, means no evidence and so no
    rename. Of rivals the mutual best wins. Per line only equal values make a pair, so fields that don't match cost nothing."""
    names = F.concat(F.transform("nuevos", lambda c: F.struct(c.alias("c"), F.lit(True).alias("n"))), F.transform("viejos", lambda c: F.struct(c.alias("c"), F.lit(False).alias("n"))))
    cand = vanished_and_new.select(*_SIDES, "p", F.explode(names).alias("x"))
    cand = cand.select(F.when(F.col("x.n"), F.col("archivo_id")).otherwise(F.col("antes")).alias("_file"), F.col("x.n").alias("_new"), F.col("x.c").alias("campo"), "p", *_SIDES)
    per_file = cand.groupBy("_file").agg(F.collect_list(F.struct("_new", "campo", "p", *_SIDES)).alias("_cand"))  # a file's fields, in two roles
    # only lines of files with a candidate are cut; a repeated line falls together further down
    cuts = layouts(lists.join(per_file.select(F.col("_file").alias("archivo_id")), "archivo_id", "left_semi")).withColumnRenamed("archivo_id", "_file").join(per_file, "_file")
    v = _cut(lines.select(F.col("archivo_id").alias("_file"), "line_no", "raw").join(cuts, "_file"), "_file", "line_no", "_cand").withColumn("x", F.explode("_cand"))
    v = v.select("x.archivo_id", "x.antes", "x.p", "line_no", F.struct(F.col("x._new").alias("n"), F.col("x.campo").alias("c"), F.try_element_at("valores", F.col("x.campo"))["v"].alias("v")).alias("y"))
    by_line = v.groupBy(*_SIDES, "p", "line_no").agg(F.collect_set("y").alias("_ys"))
    of = lambda new: F.filter("_ys", lambda y: y["n"] if new else ~y["n"])
    by_line = by_line.withColumn("_n", of(True)).withColumn("_o", of(False)).where((F.size("_n") > 0) & (F.size("_o") > 0))
    full = lambda c: F.filter(c, lambda y: F.trim(y["v"]) != "")
    none = F.lit(None).cast("string")
    hit = lambda a, b: F.struct(a.alias("nuevo"), b.alias("viejo"))
    equal = F.flatten(F.transform(full("_n"), lambda a: F.transform(F.filter("_o", lambda b: b["v"] == a["v"]), lambda b: hit(a["c"], b["c"]))))
    alone = F.concat(F.transform(full("_n"), lambda a: hit(a["c"], none)), F.transform(full("_o"), lambda b: hit(none, b["c"])))
    n = by_line.select(*_SIDES, F.explode(F.concat(equal, alone)).alias("h")).groupBy(*_SIDES, "h").agg(F.count(F.lit(1)).alias("k"))
    r = n.groupBy(*_SIDES).agg(F.collect_list(F.struct("h.nuevo", "h.viejo", "k")).alias("_r"))
    filled = lambda c, other: F.map_from_entries(F.transform(F.filter("_r", lambda x: x[other].isNull()), lambda x: F.struct(x[c], x["k"])))
    r = r.withColumn("_fn", filled("nuevo", "viejo")).withColumn("_fo", filled("viejo", "nuevo"))
    both = F.filter("_r", lambda x: x["nuevo"].isNotNull() & x["viejo"].isNotNull())
    share = F.transform(both, lambda x: F.struct(x["nuevo"].alias("nuevo"), x["viejo"].alias("viejo"), (x["k"] / F.greatest(F.element_at("_fn", x["nuevo"]), F.element_at("_fo", x["viejo"]))).alias("s")))
    r = r.withColumn("_s", F.filter(share, lambda x: x["s"] >= RENAME_SHARE))
    beats = lambda y, x, mine, other: (y[mine] == x[mine]) & ((y["s"] > x["s"]) | ((y["s"] == x["s"]) & (y[other] < x[other])))
    best = F.filter("_s", lambda x: ~F.exists("_s", lambda y: beats(y, x, "nuevo", "viejo") | beats(y, x, "viejo", "nuevo")))
    return r.select(*_SIDES, F.explode(best).alias("x")).select(*_SIDES, F.col("x.nuevo").alias("campo"), F.col("x.viejo").alias("campo_antes"))


def _shown(p: str) -> Column:
    """A picture as text: kind, width, decimals, sign."""
    return F.concat(F.col(f"{p}.kind"), F.lit("("), F.col(f"{p}.width"), F.lit(","), F.col(f"{p}.decimals"), F.lit(")"), F.when(F.col(f"{p}.signed"), "s").otherwise(""))


def schema_changes(fields: DataFrame, lines: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """(archivo_id, antes, campo, campo_antes, cambio, imagen_antes, imagen, tipos_antes, tipos): each change of a file against its series' previous delivered period.

    imagen is the declared picture, tipos the raw types that the file's values really have, from the path-type statistics;
    null where the file has no such field, '' where it has no lines. A field whose values are blank, or without common
    lines, is never a rename: it is removed and added. lists: field_lists of the same fields, if they are written already. Empty
    tables give no rows."""
    lists = checkpointed(field_lists(fields)) if lists is None else lists  # read by every part of the comparison
    pairs = checkpointed(deliveries(lists).where("antes IS NOT NULL").select(*_SIDES))  # two numbers a delivery
    seen = path_statistics(path_values(lines, lists))
    types = F.array_join(F.array(*[F.when(F.col(t) > 0, F.lit(t)) for t in RAW_TYPES]), "|")
    stats = lists.select("archivo_id", "campo", F.struct("kind", "signed", "decimals", "width").alias("p")).join(seen, ["archivo_id", "campo"], "left")
    stats = stats.select("archivo_id", "campo", F.struct("p", F.coalesce(types, F.lit("")).alias("t")).alias("s"))
    side = lambda new: F.max(F.when(F.col("_new") if new else ~F.col("_new"), F.col("s")))
    both = _in_both_roles(stats, pairs).groupBy(*_SIDES, "campo").agg(side(True).alias("n"), side(False).alias("o"))
    both = checkpointed(both.where("o IS NULL OR n IS NULL OR n.p <> o.p"))
    lone = both.where("o IS NULL OR n IS NULL").groupBy(*_SIDES, F.coalesce("n.p", "o.p").alias("p"))
    lone = lone.agg(F.collect_list(F.when(F.col("o").isNull(), F.col("campo"))).alias("nuevos"), F.collect_list(F.when(F.col("n").isNull(), F.col("campo"))).alias("viejos"))
    moved = renames(lone.where((F.size("nuevos") > 0) & (F.size("viejos") > 0)), lines, lists)
    ends = moved.select(*_SIDES, F.explode(F.array(F.struct(F.col("campo"), F.struct("campo", "campo_antes").alias("m")), F.struct(F.col("campo_antes").alias("campo"), F.struct("campo", "campo_antes").alias("m")))).alias("e")).select(*_SIDES, "e.*")
    got = both.join(ends, [*_SIDES, "campo"], "left")
    # the two halves of a rename fall together
    rename = got.where("m IS NOT NULL").groupBy(*_SIDES, "m").agg(F.max("n").alias("n"), F.max("o").alias("o")).select(*_SIDES, "m.campo", "m.campo_antes", F.lit("renamed").alias("cambio"), "n", "o")
    typed = (F.col("n.p.kind") != F.col("o.p.kind")) | (F.col("n.p.signed") != F.col("o.p.signed")) | (F.col("n.p.decimals") != F.col("o.p.decimals"))
    kind = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(typed, "retyped").otherwise("resized")
    rest = got.where("m IS NULL").select(*_SIDES, "campo", F.lit(None).cast("string").alias("campo_antes"), kind.alias("cambio"), "n", "o")
    all_ = rest.unionByName(rename)
    return all_.select(*_SIDES, "campo", "campo_antes", "cambio", _shown("o.p").alias("imagen_antes"), _shown("n.p").alias("imagen"), F.col("o.t").alias("tipos_antes"), F.col("n.t").alias("tipos"))


def aliases(changes: DataFrame, lists: DataFrame) -> tuple[dict[tuple[str, str], str], list[tuple[str, str, str]]]:
    """Canonical name of every (letra, name) that was ever renamed, the least of those linked; and the links refused.

    A rename holds for its record type (letra), so that its series share a column, but names that any file of that type
    has together are different fields: a link that would join two of them is refused and reported as (letra, name, former
    name). What comes to the driver is the vocabulary of field names and the sets of them that occur together, which the
    formats bound, not the data."""
    of = lists.select("archivo_id", "letra").distinct()
    renamed = changes.where("cambio = 'renamed'").select("archivo_id", "campo", "campo_antes").join(of, "archivo_id").select("letra", "campo", "campo_antes").distinct()
    links = sorted((r[0] or "", r[1], r[2]) for r in renamed.collect())
    words = renamed.select("letra", F.explode(F.array("campo", "campo_antes")).alias("campo")).distinct()
    held = lists.select("archivo_id", "letra", "campo").join(words, ["letra", "campo"], "left_semi")
    sets = held.groupBy("archivo_id", "letra").agg(F.array_sort(F.collect_set("campo")).alias("s")).select("letra", "s").where(F.size("s") > 1).distinct()
    apart: dict[tuple[str, str], set[str]] = {}
    for r in sets.collect():
        for c in r["s"]:
            apart.setdefault((r["letra"] or "", c), set()).update(x for x in r["s"] if x != c)
    group = {(x, c): {c} for x, a, b in links for c in (a, b)}
    refused = []
    for x, a, b in links:
        one, two = group[x, a], group[x, b]
        if one is two:
            continue
        if any(apart.get((x, c), set()) & two for c in one):
            refused.append((x, a, b))
            continue
        one |= two
        for c in two:
            group[x, c] = one
    return {k: min(v) for k, v in group.items()}, refused


def _typed(v: Column, kind: str) -> Column:
    t = F.trim(v["v"])
    if kind == "date":
        return F.coalesce(F.when(t.rlike("^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd")), F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(t, "yyyy-MM-dd")))
    if kind == "number":
        whole = F.when(t.rlike("^[-+]?[0-9]+$"), t).try_cast("decimal(38,0)").cast("decimal(38,6)")
        return F.try_divide(whole, F.pow(F.lit(10.0), v["decimals"])).cast("decimal(38,6)")
    return F.nullif(t, F.lit(""))


#: Columns of the table that no field may be called.
OWN = ("archivo_id", "line_no", "serie_id", "letra", "periodo", "_fallidos")


def one_table(fields: DataFrame, lines: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """All lines of all files as one table: a typed column for each canonical field, and `_fallidos`, the fields whose cast failed.

    A field's type follows from all files' path-type statistics: date, number, else text. A field that a file lacks is null;
    names that one file has together keep a column each (see aliases). A field called as one of OWN gets `campo_` before its
    name. Empty tables give no rows."""
    lists = checkpointed(field_lists(fields))
    known, _ = aliases(checkpointed(schema_changes(fields, lines, lists)) if changes is None else changes, lists)
    files = lists.select("archivo_id", "serie_id", "letra", "periodo").distinct()
    values = path_values(lines, lists).join(files, "archivo_id")
    if known:
        to = F.create_map(*[F.lit(x) for (letter, c), n in sorted(known.items()) if c != n for x in (f"{letter}|{c}", n)])
        values = values.withColumn("valores", F.transform_keys("valores", lambda k, _: F.coalesce(F.try_element_at(to, F.concat_ws("|", F.coalesce("letra", F.lit("")), k)), k)))
    values = checkpointed(values)  # read for the statistics and for the table; a filter on the table then doesn't cut lines again
    sums = path_statistics(values).groupBy("campo").agg(*[F.sum(t).alias(t) for t in RAW_TYPES]).collect()  # vocabulary
    kinds = {}
    for r in sorted(sums):
        filled = sum(r[t] for t in RAW_TYPES if t != "empty")
        share = lambda *ts: sum(r[t] for t in ts) >= TYPE_SHARE * filled > 0  # noqa: E731, B023
        kinds[r["campo"]] = "date" if share("date8", "iso") else "number" if share("int", "signed", "date8") else "text"
    pick = {n: F.try_element_at("valores", F.lit(n)) for n in kinds}
    cols = [_typed(pick[n], k).alias(f"campo_{n.lower()}" if n.lower() in OWN else n.lower()) for n, k in kinds.items()]
    bad = F.array_compact(F.array(*[F.when((F.trim(pick[n]["v"]) != "") & _typed(pick[n], k).isNull(), F.lit(n)) for n, k in kinds.items()])) if kinds else F.array().cast(T.ArrayType(T.StringType()))
    return values.select("archivo_id", "line_no", *cols, bad.alias("_fallidos"), "serie_id", "letra", "periodo")
