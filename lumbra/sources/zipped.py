"""Lines of fixed-width members of ZIP archives, as a Python data source.

    spark.dataSource.register(ZippedLines)
    spark.read.format("zipped_lines").option("letters", "I,P").load("/landing")

An archive can't be split, its members can: each member is a partition of its own, read as a stream.
The folder must be one that all executors see. `archives` reads from any file system that Spark knows, and opens no
archive on the driver: an archive is a row, its members are planned in the tasks.
"""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lumbra.session import ship

# Member names, and encodings in the order in which they are tried.
MEMBER = re.compile(r"^([a-z])(\d{6})([vg]?)\.(\d{6,9})$", re.I)
ENCODINGS = ("utf-8", "cp1252", "latin-1")
SCHEMA = "zip_origen string, source_file string, letra string, rut_compania long, periodo int, line_no int, raw string"


def period(token: str) -> int | None:
    """AAAAMM if that is a month, else AAMMDD of a closing date."""
    y, m = int(token[:4]), int(token[4:])
    if 2000 <= y <= 2100 and 1 <= m <= 12:
        return y * 100 + m
    return (2000 + int(token[:2])) * 100 + int(token[2:4]) if 1 <= int(token[2:4]) <= 12 and 1 <= int(token[4:]) <= 31 else None


def encoding_of(archive: zipfile.ZipFile, member: str) -> str:
    """The first encoding that reads the whole member; found in one pass that holds a block at a time."""
    live = {enc: codecs.getincrementaldecoder(enc)() for enc in ENCODINGS[:-1]}
    with archive.open(member) as f:
        while live and (block := f.read(1 << 20)):
            live = {enc: d for enc, d in live.items() if _reads(d, block)}
    live = {enc: d for enc, d in live.items() if _reads(d, b"", True)}
    return next(iter(live), ENCODINGS[-1])


def _reads(decoder: codecs.IncrementalDecoder, block: bytes, final: bool = False) -> bool:
    try:
        decoder.decode(block, final)
    except UnicodeDecodeError:
        return False
    return True


def wanted(name: str, letters: set[str], at: int | None) -> re.Match | None:
    """The match of a member's name if it has one of the letters and that period; no letters or no period mean any."""
    m = MEMBER.match(name.rsplit("/", 1)[-1])
    return m if m and (not letters or m[1].upper() in letters) and (not at or period(m[2]) == at) else None


def lines_of(archive: zipfile.ZipFile, zip_name: str, member: str) -> Iterator[tuple]:
    """Rows of SCHEMA, without lines of blanks only."""
    base = member.rsplit("/", 1)[-1]
    m = MEMBER.match(base)
    # only a line feed ends a line: other marks that end lines elsewhere are content here
    with io.TextIOWrapper(archive.open(member), encoding=encoding_of(archive, member), newline="\n") as f:
        for i, line in enumerate(f, 1):
            line = line.rstrip("\n").removesuffix("\r")
            if line.strip():
                yield (zip_name, base, m[1].upper(), int(m[4]), period(m[2]), i, line)


def archives(spark: SparkSession, path: str, letters: str = "", at: int | None = None, batch: int = 20_000) -> DataFrame:
    """Lines of the members of all archives under path, on any file system. Archives are listed, opened and read in tasks;
    one archive of up to 2 GB is held by a task. Archives that can't be opened fail the read; no archive gives no rows."""
    ship(spark)
    chosen = {x.strip().upper() for x in letters.split(",") if x.strip()}
    names = SCHEMA.replace(",", "").split()[::2]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    rows = (r for n in sorted(archive.namelist()) if wanted(n, chosen, at) for r in lines_of(archive, where.rsplit("/", 1)[-1], n))
                    while part := list(islice(rows, batch)):
                        yield pd.DataFrame(part, columns=names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    return found.select("path", "content").mapInPandas(read, SCHEMA)


class Member(InputPartition):
    def __init__(self, archive: str, name: str):
        self.archive, self.name = archive, name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path", "")
        self.letters = {x.strip().upper() for x in options.get("letters", "").split(",") if x.strip()}
        self.period = options.get("period")

    def partitions(self) -> list[Member]:
        out = []
        root = Path(self.path.removeprefix("file://"))
        for z in sorted([root] if root.is_file() else root.rglob("*.zip")):
            with zipfile.ZipFile(z) as archive:
                out += [Member(str(z), name) for name in sorted(archive.namelist()) if wanted(name, self.letters, int(self.period or 0))]
        return out or [Member("", "")]

    def read(self, part: Member) -> Iterator[tuple]:
        if not part.archive:
            return
        with zipfile.ZipFile(part.archive) as archive:
            yield from lines_of(archive, Path(part.archive).name, part.name)


class ZippedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipped_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))
