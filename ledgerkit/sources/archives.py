"""Archive and loose-file sources.

An archive is never a cell of a table.  Spark lists the archives (paths and lengths, no content);
a first step reads their directories on the executors and cuts them into ranges of members of
bounded bytes, large inner archives too; a second step, one task a range, reads just the members.
Late reading (:func:`read_members`) takes a table of filing ids instead and opens no other member.
A filing is keyed by (full archive path, inner path), so neither equal member names nor equal
archive names overwrite each other.

Executors open archives by random access through Arrow's file systems: local or mounted folders,
and the stores that Arrow can reach (``s3://``, ``gs://``, ``hdfs://``).
"""
from __future__ import annotations

import datetime
import hashlib
import posixpath
import re
import urllib.parse
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .catalogs import MONTHS

FILING_SCHEMA = T.StructType([
    T.StructField("filing_id", T.StringType()), T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()), T.StructField("member_ord", T.LongType()),
    T.StructField("source_file", T.StringType()), T.StructField("published", T.DateType()),
    T.StructField("content", T.BinaryType()),
])
DEFAULT_SUFFIXES = (".html", ".xml")
BATCH_BYTES = 8_000_000
#: A range ends with the member that reaches either of these (bytes as compressed).
RANGE_BYTES, RANGE_MEMBERS = 32_000_000, 500
#: Tasks among which the wanted members of one archive are dealt.
READERS = 16
_MONTH_OF = {m: i for i, m in enumerate(MONTHS, 1)}


def archive_date(name: str):
    """The day in a daily archive's name, the first of the month in a monthly one's
    (``...-January2025.zip``), else None."""
    day = re.search(r"([0-9]{4})-([0-9]{2})-([0-9]{2})", name)
    month = re.search(r"([A-Za-z]+)([0-9]{4})", name.rpartition("-")[2])
    try:
        if day:
            return datetime.date(*map(int, day.groups()))
        if month and month[1].lower() in _MONTH_OF:
            return datetime.date(int(month[2]), _MONTH_OF[month[1].lower()], 1)
    except ValueError:  # digits that are no date
        pass
    return None


def _content(z: zipfile.ZipFile, info: zipfile.ZipInfo):
    try:
        return z.read(info)
    except (zipfile.BadZipFile, OSError, EOFError, NotImplementedError, RuntimeError):
        return None  # a member that cannot be read becomes a reject


def open_file(path: str) -> pa.NativeFile:
    """A file for random access by the path that Spark lists it under."""
    scheme, _, rest = path.partition(":")
    if not rest.startswith("/") or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if scheme == "file" else path)
    system, inside = fs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/@"))
    return system.open_input_file(inside)


def _entries(z: zipfile.ZipFile) -> list[tuple[int, zipfile.ZipInfo]]:
    """(number, entry) in order; of entries of one name the last one counts, as ZIP readers have it."""
    last = {info.filename: k for k, info in enumerate(z.infolist())}
    return [(k, info) for k, info in enumerate(z.infolist()) if last[info.filename] == k]


def _is_archive(name: str) -> bool:
    return name.lower().endswith(".zip")


def _inner(outer: zipfile.ZipFile, name: str) -> zipfile.ZipFile | None:
    """An archive in an archive, read through the outer one; None if it is bad."""
    try:
        return zipfile.ZipFile(outer.open(name))
    except (zipfile.BadZipFile, OSError, EOFError, NotImplementedError, RuntimeError):
        return None


def ranges_of(z: zipfile.ZipFile, suffixes, most_bytes: int, most: int, inner: str | None = None) -> Iterator[tuple[str | None, int, int, int]]:
    """(inner archive, first entry, entry past the last, bytes): the ranges of filings of an archive and,
    one level deep, of its inner ones."""
    first, past, size, n = None, 0, 0, 0
    for k, info in _entries(z):
        if info.filename.lower().endswith(suffixes):
            first = k if first is None else first
            past, size, n = k + 1, size + info.compress_size, n + 1
            if size >= most_bytes or n >= most:
                yield inner, first, past, size
                first, size, n = None, 0, 0
    if first is not None:
        yield inner, first, past, size
    if inner is None:
        for _, info in _entries(z):
            deep = _inner(z, info.filename) if _is_archive(info.filename) else None
            if deep is not None:
                yield from ranges_of(deep, suffixes, most_bytes, most, info.filename)


def _filing(path: str, z: zipfile.ZipFile, info: zipfile.ZipInfo, ord_: int, key: str) -> tuple:
    archive = posixpath.basename(path)
    return (f"{path}!{key}", archive, key, ord_, posixpath.basename(info.filename), archive_date(archive), _content(z, info))


def range_filings(path: str, outer: zipfile.ZipFile, inner: str | None, first: int, past: int, suffixes) -> Iterator[tuple]:
    """Rows of FILING_SCHEMA of a range."""
    z = outer if inner is None else _inner(outer, inner)
    base = 0 if inner is None else next(k for k, i in _entries(outer) if i.filename == inner) << 24
    for k, info in _entries(z):
        if first <= k < past and info.filename.lower().endswith(suffixes):
            yield _filing(path, z, info, (k << 24) if inner is None else base + k, info.filename if inner is None else f"{inner}!{info.filename}")


def wanted_filings(path: str, outer: zipfile.ZipFile, keys: list[str]) -> Iterator[tuple]:
    """Rows of FILING_SCHEMA of the members of these keys; members that are not there give none."""
    place = {info.filename: (k, info) for k, info in _entries(outer)}
    deeper: dict[str, list[str]] = {}
    for key in keys:
        if key in place:
            yield _filing(path, outer, place[key][1], place[key][0] << 24, key)
        else:
            name = next((key[:m.start() + 4] for m in re.finditer(r"(?i)\.zip!", key) if key[:m.start() + 4] in place), None)
            if name is not None:
                deeper.setdefault(name, []).append(key[len(name) + 1:])
    for name, members in deeper.items():
        z = _inner(outer, name)
        there = {info.filename: (j, info) for j, info in _entries(z)} if z is not None else {}
        for member in members:
            if member in there:
                yield _filing(path, z, there[member][1], (place[name][0] << 24) + there[member][0], f"{name}!{member}")


_ARROW = pa.schema([("filing_id", pa.string()), ("archive", pa.string()), ("member", pa.string()), ("member_ord", pa.int64()),
                    ("source_file", pa.string()), ("published", pa.date32()), ("content", pa.binary())])


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)


def _opened(path: str) -> zipfile.ZipFile | None:
    """The archive, None if the file is none (or too short to be one)."""
    try:
        return zipfile.ZipFile(open_file(path))
    except (zipfile.BadZipFile, pa.ArrowInvalid):
        return None


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(path, length) of every archive under ``path``; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(path).select("path", "length"))


def archive_months(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, length) of archives -> (month, archive, length); the month is null where the name holds no date."""
    for b in batches:
        paths = b.column("path").to_pylist()
        days = [archive_date(posixpath.basename(p)) for p in paths]
        yield pa.RecordBatch.from_arrays([pa.array([d and d.strftime("%Y-%m") for d in days], pa.string()), pa.array(paths, pa.string()),
                                          b.column("length")], ["month", "archive", "length"])


def member_ranges(archives: DataFrame, suffixes=DEFAULT_SUFFIXES, most_bytes: int = RANGE_BYTES, most: int = RANGE_MEMBERS) -> DataFrame:
    """(path, inner, first, past, bytes): the ranges of members of each archive, from its directory alone.
    An archive that is none has no range."""
    sfx = tuple(s.lower() for s in suffixes)

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                z = _opened(path)
                rows = [(path, *r) for r in ranges_of(z, sfx, most_bytes, most)] if z is not None else []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                                     ["path", "inner", "first", "past", "bytes"])

    return archives.select("path").mapInArrow(run, "path string, inner string, first long, past long, bytes long")


def read_ranges(ranges: DataFrame, suffixes=DEFAULT_SUFFIXES) -> DataFrame:
    """The filings of (path, inner, first, past), one task a range."""
    sfx = tuple(s.lower() for s in suffixes)

    def run(batches):
        for b in batches:
            for path, inner, first, past in zip(*(b.column(c).to_pylist() for c in ("path", "inner", "first", "past"))):
                yield from _batches(range_filings(path, _opened(path), inner, first, past, sfx))

    return ranges.select("path", "inner", "first", "past").repartition(max(1, ranges.count())).mapInArrow(run, FILING_SCHEMA)


def read_archives(archives: DataFrame, suffixes=DEFAULT_SUFFIXES, most_bytes: int = RANGE_BYTES, most: int = RANGE_MEMBERS) -> DataFrame:
    """(path) of archives -> one row per filing, read range by range."""
    return read_ranges(materialise(member_ranges(archives, suffixes, most_bytes, most)), suffixes)


def scan_archives(spark: SparkSession, path: str, glob: str = "*.zip", suffixes=DEFAULT_SUFFIXES) -> DataFrame:
    """Every ZIP under ``path`` (recursively) -> filings."""
    return read_archives(list_archives(spark, path, glob), suffixes)


def list_filings(archives: DataFrame, suffixes=DEFAULT_SUFFIXES) -> DataFrame:
    """The filings of archives as FILING_SCHEMA has them, without content: from the directories alone,
    so that a choice can be made before :func:`read_members` opens anything."""
    sfx = tuple(s.lower() for s in suffixes)
    schema = T.StructType([f for f in FILING_SCHEMA.fields if f.name != "content"])

    def names(path, z):
        for k, info in _entries(z):
            if info.filename.lower().endswith(sfx):
                yield info.filename, info.filename, k << 24
            elif _is_archive(info.filename) and (deep := _inner(z, info.filename)) is not None:
                for j, one in _entries(deep):
                    if one.filename.lower().endswith(sfx):
                        yield f"{info.filename}!{one.filename}", one.filename, (k << 24) + j

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                z, archive = _opened(path), posixpath.basename(path)
                rows = [(f"{path}!{key}", archive, key, ord_, posixpath.basename(name), archive_date(archive))
                        for key, name, ord_ in (names(path, z) if z is not None else ())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], names=_ARROW.names[:-1])

    return archives.select("path").mapInArrow(run, schema)


def read_members(wanted: DataFrame) -> DataFrame:
    """The filings of the ids in ``wanted`` (filing_id), each id once; archives are opened for
    these members only.  Ids that are no member of an archive give no row."""
    ids = wanted.select("filing_id", F.regexp_extract("filing_id", r"(?i)^(.*?\.zip)!", 1).alias("path")).where("path != ''").distinct()

    def run(batches):
        path, keys = None, []
        for b in batches:
            for one, id_ in zip(b.column("path").to_pylist(), b.column("filing_id").to_pylist()):
                if one != path or len(keys) >= RANGE_MEMBERS:
                    yield from _read(path, keys)
                    path, keys = one, []
                keys.append(id_[len(one) + 1:])
        yield from _read(path, keys)

    def _read(path, keys):
        z = _opened(path) if keys else None
        if z is not None:
            yield from _batches(wanted_filings(path, z, keys))

    dealt = ids.repartition("path", F.pmod(F.xxhash64("filing_id"), F.lit(READERS)))
    return dealt.sortWithinPartitions("path", "filing_id").mapInArrow(run, FILING_SCHEMA)


def archive_digests(archives: DataFrame) -> DataFrame:
    """(path, length, sha256) of archives of any size, hashed a piece at a time."""
    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                state, size = hashlib.sha256(), 0
                with open_file(path) as f:
                    while piece := f.read(BATCH_BYTES):
                        state.update(piece)
                        size += len(piece)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([state.hexdigest()])], ["path", "length", "sha256"])

    paths = archives.select("path").distinct()
    return paths.repartition("path").mapInArrow(run, "path string, length long, sha256 string")


def scan_filings(spark: SparkSession, path: str, suffixes=DEFAULT_SUFFIXES) -> DataFrame:
    """Loose filings under ``path``, suffix matched case-insensitively."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | F.lower("path").endswith(s)
    name = F.element_at(F.split("path", "/"), -1)
    return raw.filter(cond).select(
        F.col("path").alias("filing_id"), F.lit(None).cast("string").alias("archive"), name.alias("member"),
        F.lit(0).cast("long").alias("member_ord"), name.alias("source_file"),
        F.try_to_date(F.regexp_extract("path", "(\\d{4}-\\d{2}-\\d{2})", 1), "yyyy-MM-dd").alias("published"),
        "content")


def archive_members(filings: DataFrame) -> DataFrame:
    """S3: basename -> member per archive; the last duplicate wins."""
    w = Window.partitionBy("archive", "source_file").orderBy(F.desc("member_ord"))
    return (filings.select("archive", "member", "member_ord", "source_file")
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "member_ord"))
