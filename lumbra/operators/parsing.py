"""Rows that fail to parse: one anchored pattern per schema, then field-prefix patterns for what failed.

A schema compiles to a pattern for the whole row. Rows that match it are loaded; the others meet the
patterns of ever longer field prefixes, and the first prefix that fails names the broken field.
Everything is an expression over the raw column: no Python, no shuffle, one pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Stand for a doubled quote, and for nothing between quotes, while patterns are matched; private characters.
DOUBLED, EMPTY = "\ue000", "\ue001"


@dataclass(frozen=True)
class Field:
    """A named piece of a row. pattern matches its value, without any quotes of its own."""

    name: str
    pattern: str
    width: int | None = None


def text(name: str, width: int) -> Field:
    return Field(name, f"[\\s\\S]{{{width}}}", width)


def digits(name: str, width: int) -> Field:
    """Unsigned number; a comma stands for the digit zero and blanks for the number zero."""
    return Field(name, f"(?:[0-9,]{{{width}}}| {{{width}}})", width)


def signed(name: str, width: int) -> Field:
    """Signed number: the first character is a sign, a blank or a digit."""
    return Field(name, f"(?:[-+ 0-9,][0-9,]{{{width - 1}}}| {{{width}}})", width)


def period(name: str) -> Field:
    """AAAAMM, a comma standing for the digit zero."""
    return Field(name, "[0-9,]{4}(?:[0,][1-9]|1[0-2,])", 6)


@dataclass(frozen=True)
class FixedWidth:
    """Record codes and their fields; each record has length characters, the rest of it is filler."""

    length: int
    codes: dict[str, list[Field]]

    def rows(self) -> str:
        return "^(?:" + "|".join(c + "".join(f.pattern for f in fs) + f"[\\s\\S]{{{self.length - 1 - sum(f.width for f in fs)}}}" for c, fs in self.codes.items()) + ")$"

    def matches(self, raw: Column) -> Column:
        return raw.rlike(self.rows())

    def reason(self, raw: Column) -> Column:
        """The first thing that is wrong: length, record code, or the first field whose prefix pattern fails."""
        why = F.when(F.char_length(raw) != self.length, F.concat(F.lit("length: "), F.char_length(raw).cast("string")))
        why = why.when(~F.substring(raw, 1, 1).isin(list(self.codes)), F.concat(F.lit("record code: "), F.substring(raw, 1, 1)))
        for code, fields in self.codes.items():
            prefix, at = f"^{code}", 2
            for f in fields:
                prefix += f.pattern
                why = why.when((F.substring(raw, 1, 1) == code) & ~raw.rlike(prefix), F.concat(F.lit(f"{f.name}: "), F.substring(raw, at, f.width)))
                at += f.width
        return why.otherwise(F.lit("row"))

    def values(self, raw: Column, code: str) -> dict[str, Column]:
        out, at = {}, 2
        for f in self.codes[code]:
            out[f.name] = F.substring(raw, at, f.width)
            at += f.width
        return out


@dataclass(frozen=True)
class Delimited:
    """Columns divided by commas, each bare or in quotes that double inside quotes."""

    fields: list[Field]

    @staticmethod
    def _column(f: Field) -> str:
        return f'(?:"(?:{f.pattern})"|(?!")(?:{f.pattern}))'

    _any = '(?:"[^"]*"|[^",]*)'

    @staticmethod
    def masked(raw: Column) -> Column:
        """raw with each quote that is doubled inside quotes as one mark, so that no pattern has to loop over them.

        Split at quotes, pieces lie outside and inside quotes by turns; an empty outer piece between others is a doubled quote."""
        outer = F.transform(F.split(raw, '"', -1), lambda x, i: F.when((F.pmod(i, F.lit(2)) == 0) & (i > 0) & (x == ""), F.lit(EMPTY)).otherwise(x))
        joined = F.replace(F.array_join(outer, '"'), F.lit(f'"{EMPTY}"'), F.lit(DOUBLED))
        return F.when(raw.contains('""'), F.replace(joined, F.lit(EMPTY), F.lit(""))).otherwise(raw)

    def matches(self, raw: Column) -> Column:
        return self.masked(raw).rlike(self.rows())

    def rows(self) -> str:
        return "^" + ",".join(f"(?:{self._column(f)})" for f in self.fields) + "$"

    def reason(self, raw: Column) -> Column:
        n, raw = len(self.fields), self.masked(raw)
        # a quote that neither opens nor closes a column, or is never closed
        stray = '(?:^|,)"[^"]*"(?=,|$)'
        why = F.when(F.contains(F.regexp_replace(raw, stray, ","), F.lit('"')), F.lit("quoting"))
        columns = F.size(F.regexp_extract_all(raw, F.lit(f"(?:^|,)({self._any})"), F.lit(0)))
        why = why.when(columns != n, F.concat(F.lit("columns: "), columns.cast("string")))
        prefix = "^"
        for i, f in enumerate(self.fields):
            prefix += f"(?:{self._column(f)})"
            end = "," if i + 1 < n else "$"
            why = why.when(~raw.rlike(prefix + end), F.lit(f.name))
            prefix += end
        return why.otherwise(F.lit("row"))

    def values(self, raw: Column) -> dict[str, Column]:
        group = "^" + ",".join(f"({self._any})" for _ in self.fields) + "$"
        out = {}
        for i, f in enumerate(self.fields):
            v = F.regexp_extract(self.masked(raw), group, i + 1)
            out[f.name] = F.when(v.startswith('"'), F.replace(v.substr(F.lit(2), F.char_length(v) - 2), F.lit(DOUBLED), F.lit('"'))).otherwise(v)
        return out


# The two formats of the filed lines.
CONTROL = FixedWidth(
    138,
    {
        "1": [digits("RUT", 9), text("VERIFICADOR", 1), text("NOMBRE", 60), period("PERIODO")],
        "2": [
            text("TIPO_DE_INVERSION", 3), digits("VALOR_FINAL", 12), signed("MONTO_1", 12), signed("MONTO_2", 12),
            *[signed(f"MONTO_{i}", 14) for i in range(3, 10)],
        ],
        "3": [digits("TOTAL_REGISTROS", 6)],
    },
)
LEGAL_NAMES = Delimited(
    [
        Field("lei", "[A-Z0-9]{20}"),
        Field("estado_lei", "ISSUED|LAPSED|RETIRED|PENDING"),
        Field("nombre_legal", '(?:(?<=")[^"]*(?=")|(?<!")[^",]*)'),
        Field("pais", "[A-Z]{2}"),
        Field("categoria", "(?:GENERAL|FUND|BRANCH)?"),
        Field("estado_entidad", "(?:ACTIVE|INACTIVE)?"),
    ]
)
HEADER = "lei,estado_lei,nombre_legal,pais,categoria,estado_entidad"
FORMATS: dict[str, FixedWidth | Delimited] = {"C": CONTROL, "L": LEGAL_NAMES}


def is_record(raw: Column) -> Column:
    """Comments, the header line, empty or blank lines and nulls are no records."""
    return F.coalesce(~raw.startswith("#") & (F.trim(raw) != "") & (F.lower(raw) != HEADER), F.lit(False))


def split_rows(lines: DataFrame, formats: dict[str, FixedWidth | Delimited] = FORMATS, raw: str = "raw", kind: str = "formato") -> DataFrame:
    """Every record with `_motivo`: null if it loads, else the reason that it doesn't.

    lines needs the columns raw and kind; all its columns are kept. Rows that are no records are left
    out. A record of an unknown or null format is rejected as such. Very long rows fail the length test
    or the column patterns, which never backtrack over more than one column. Repeated rows are kept.
    """
    r, k = F.col(raw), F.col(kind)
    good = reduce(lambda a, b: a | b, [(k == name) & f.matches(r) for name, f in formats.items()], F.lit(False))
    why = reduce(lambda a, nf: a.when(k == nf[0], nf[1].reason(r)), formats.items(), F.when(k.isNull(), F.lit("format: null")))
    why = why.otherwise(F.concat(F.lit("format: "), k))
    return lines.where(is_record(r)).withColumn("_motivo", F.when(~F.coalesce(good, F.lit(False)), why))


def rejected(lines: DataFrame, **options) -> DataFrame:
    """The records that don't load, as a quarantine row has them; repeated deliveries of a line come out once."""
    cols = ["periodo_informacion", "fecha_descarga", "zip_origen", "source_file", "line_no", "rut_compania"]
    got = split_rows(lines, **options).where("_motivo IS NOT NULL")
    return got.select(
        *cols, F.col("formato").alias("archivo"), F.when(F.col("formato") == "C", F.substring("raw", 1, 1)).alias("record_type"),
        F.lit("rejected").alias("veredicto"), F.col("_motivo").alias("motivos"), "raw",
    ).distinct()


def _number(v: Column, sign: bool) -> Column:
    v = F.translate(v, ",", "0")
    n = F.expr("try_cast(NULL AS BIGINT)")
    body = F.when(F.trim(v) == "", F.lit(0)).otherwise(F.regexp_replace(v, "^[-+ ]", "").try_cast("bigint"))
    return F.coalesce(F.when(v.startswith("-"), -body).otherwise(body) if sign else body, n)


def loaded_control(lines: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The detail lines of the control format that load, with typed amounts and the columns `more` of the lines; repeats once."""
    got = split_rows(lines).where((F.col("_motivo").isNull()) & (F.col("formato") == "C") & F.col("raw").startswith("2"))
    v = CONTROL.values(F.col("raw"), "2")
    cols = [F.trim(v.pop("TIPO_DE_INVERSION")).alias("tipo_inversion")]
    cols += [_number(c, n != "VALOR_FINAL").alias(n.lower()) for n, c in v.items()]
    return got.select("zip_origen", "source_file", "line_no", *more, *cols).distinct()


def loaded_names(lines: DataFrame) -> DataFrame:
    """The legal-name lines that load, unquoted; empty optional columns are null; repeats once."""
    got = split_rows(lines).where((F.col("_motivo").isNull()) & (F.col("formato") == "L"))
    v = LEGAL_NAMES.values(F.col("raw"))
    return got.select("zip_origen", "source_file", "line_no", *[F.nullif(c, F.lit("")).alias(n) for n, c in v.items()]).distinct()
