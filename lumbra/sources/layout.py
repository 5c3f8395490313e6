"""Declarative fixed-width layouts, compiled to a schema and to column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbra.functions import dates, numbers, text

_PICTURE = re.compile(r"^([-+S]?)(9|X)(?:\((\d+)\))?(9*|X*)(?:V(9*)(?:9?\((\d+)\))?)?$")


@dataclass(frozen=True)
class Field:
    """start counts from 0; kind is text, num or date; origin tells how sure the position is."""

    name: str
    start: int
    picture: str
    kind: str = "text"
    origin: str = "transcribed"

    @property
    def shape(self) -> tuple[int, int, bool]:
        """(width, decimals, signed)"""
        p = self.picture.upper().replace(" ", "")
        signed = p[:1] in "-+S"
        whole, _, part = p.lstrip("-+S").partition("V")
        count = lambda s: sum(int(n) if n else 1 for n in re.findall(r"[9XA](?:\((\d+)\))?", s))
        if not re.fullmatch(r"(?:[9XA](?:\(\d+\))?)+", whole) or part and not re.fullmatch(r"(?:9(?:\(\d+\))?)+", part):
            raise ValueError(f"{self.name}: picture {self.picture!r} can't be read")
        return count(whole) + count(part) + signed, count(part), signed

    @property
    def width(self) -> int:
        return self.shape[0]

    def value(self, raw: Column) -> Column:
        width, decimals, signed = self.shape
        chunk = F.substring(raw, self.start + 1, width)
        if self.kind == "num":
            return numbers.filed_number(chunk, width, decimals, signed)
        return dates.filed_date(chunk) if self.kind == "date" else text.clean(chunk)


@dataclass(frozen=True)
class Layout:
    """Records of one letter: their length, and the fields of each record code."""

    letter: str
    length: int
    records: dict[str, list[Field]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for code, fields in self.records.items():
            end, last = 1, "code"
            for f in sorted(fields, key=lambda f: f.start):
                if f.start < end:
                    raise ValueError(f"{self.letter}/{code}: {f.name} overlaps {last}")
                end, last = f.start + f.width, f.name
            if end > self.length:
                raise ValueError(f"{self.letter}/{code}: {last} ends beyond {self.length}")

    def gaps(self, code: str) -> list[tuple[int, int]]:
        """Stretches that no field covers; a warning, not an error."""
        out, end = [], 1
        for f in sorted(self.records[code], key=lambda f: f.start):
            if f.start > end:
                out.append((end, f.start))
            end = f.start + f.width
        return out + ([(end, self.length)] if end < self.length else [])

    def parsed(self, lines: DataFrame, code: str, raw: str = "raw") -> DataFrame:
        """Typed records of one code, with `_bad`: the fields whose text gives no value. Positions count characters, not bytes.

        Lines of another length or code are left out; see strays."""
        r = F.col(raw)
        own = lines.where((F.char_length(r) == self.length) & (F.substring(r, 1, 1) == code))
        values = {f.name: f.value(r) for f in self.records[code]}
        empty = lambda f: (F.trim(F.substring(r, f.start + 1, f.width)) == "") | F.coalesce(F.substring(r, f.start + 1, f.width).rlike("^0+$"), F.lit(False))
        bad = F.array_compact(F.array(*[F.when(values[f.name].isNull() & ~empty(f), F.lit(f.name)) for f in self.records[code]]))
        return own.select(*[c for c in lines.columns if c not in values], *[v.alias(n) for n, v in values.items()], bad.alias("_bad"))

    def facts(self, lines: DataFrame, code: str, names: dict[str, str], derived: dict[str, Column] | None = None, raw: str = "raw") -> DataFrame:
        """Rows of a fact from the records of one code: the lines' own columns, the fields under the fact's names, then derived columns,
        each of which may read those before it. Fields without a name in the fact are left out; one that the record lacks is null."""
        rows = self.parsed(lines, code, raw)
        own = [c for c in lines.columns if c != raw]
        rows = rows.select(*own, *[(F.col(f) if f in rows.columns else F.lit(None)).alias(n) for f, n in names.items()], "_bad")
        for name, c in (derived or {}).items():
            rows = rows.withColumn(name, c)
        return rows

    def strays(self, lines: DataFrame, raw: str = "raw") -> DataFrame:
        """Lines that no record takes, with `_why`: length or code."""
        r = F.col(raw)
        why = F.when(F.char_length(r) != self.length, F.concat(F.lit("length "), F.char_length(r).cast("string"))).when(~F.substring(r, 1, 1).isin(*self.records), F.concat(F.lit("code "), F.substring(r, 1, 1)))
        return lines.withColumn("_why", why).where("_why IS NOT NULL")


def load(spec: dict) -> dict[str, Layout]:
    """Layouts from a mapping such as a parsed YAML or JSON file gives: {letter: {length, records: {code: [{name, start, picture, kind}]}}}.

    A given len that differs from the picture's is an error."""
    out = {}
    for letter, x in spec.items():
        records = {}
        for code, fs in x["records"].items():
            fields = [Field(f["name"], f["start"], f["picture"], f.get("kind", "text"), f.get("origin", "transcribed")) for f in fs]
            for f, own in zip(fs, fields):
                if "len" in f and f["len"] != own.width:
                    raise ValueError(f"{letter}/{code}: {own.name} has len {f['len']}, its picture {own.width}")
            records[str(code)] = fields
        out[letter] = Layout(letter, x["length"], records)
    return out


def coverage(spark: SparkSession, layouts: dict[str, Layout]) -> DataFrame:
    """(letra, codigo, origen, campos): how many fields of each record have which origin."""
    rows = [(lo.letter, code, f.origin) for lo in layouts.values() for code, fs in lo.records.items() for f in fs]
    df = spark.createDataFrame(rows, "letra string, codigo string, origen string")
    return df.groupBy("letra", "codigo", "origen").agg(F.count(F.lit(1)).alias("campos"))
