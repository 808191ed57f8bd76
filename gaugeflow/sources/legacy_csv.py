"""Legacy-encoded CSV files, plain or inside ZIP archives, as all-text tables.

Both readers work from a small catalogue with one row per file: address,
encoding, header. The encoding is the first of the given ones that decodes the
whole file. Cells are split and padded by Spark; Python only turns bytes into
text.

* Plain files are read by the CSV source as single-byte text, which keeps every
  byte and lets Spark split files of any size; the trial decoding of a file is
  an aggregate over its lines.
* Archives are scanned once (:func:`scan_archives`). The entries of an archive are
  dealt to the tasks in ranges, each of which reads the directory once; a member is
  inflated once, in pieces, while all decoders run side by side. What comes out is
  one table, written to the shared folder: blocks of whole lines, still encoded,
  and a row per member with its encoding, header and report. Catalogue, report,
  lines and rejects are read from it, so neither an archive nor a member has to fit
  in memory, and a lost executor costs its ranges only.

Quoting is off. Lines with too many fields are skipped, short lines padded with
null, blank lines ignored, header cells stripped.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import lzma
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.columns import col
from gaugeflow.operators.guards import lookup_join
from gaugeflow.session import materialise, qualified, shared_dir
from gaugeflow.sources.storage import ENCODINGS, list_files, member_name, open_binary, pieces_of, write_binary

# Cells that mean "missing".
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Encodings that the encoding report tells apart.
REPORT_ENCODINGS = ("ascii", *ENCODINGS)

SOURCE = "source_file"
RANGE_ENTRIES, RANGE_BYTES = 256, 1 << 26  # members of an archive that one task unit reads, and their size, at most
BLOCK_BYTES = 1 << 20  # of a block of lines, unless one line is longer
MEMBER = "path string, archive string, part bigint, entry string, offset bigint, member string, size bigint"
CATALOGUE = ["path", "archive", "part", "entry", "offset", "member", "size", "error", "encoding", "header"]
SCANNED = MEMBER + ", error string, encoding string, header array<string>, report_encoding string, confidence double, block bigint, first_line bigint, data binary"
# What reading a damaged, encrypted or unknown kind of archive raises; failures of the storage are not among them.
BROKEN = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, struct.error, EOFError, NotImplementedError, RuntimeError, ValueError)


def header_cells(line: str) -> list[str]:
    """Stripped, non-empty, distinct column names of a header line."""
    names: list[str] = []
    for i, cell in enumerate(line.lstrip("\ufeff").rstrip("\r\n").split(",")):
        name = cell.strip() or f"Unnamed: {i}"
        base, n = name, 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def _first_line(stream):
    """The first line that is not blank: the header."""
    for line in iter(stream.readline, stream.read(0)):
        if line.strip():
            return line
    return stream.read(0)


def _csv_entries(archive: zipfile.ZipFile) -> Iterator[tuple[zipfile.ZipInfo, str]]:
    for info in archive.infolist():
        name = member_name(info)
        if not info.is_dir() and name.lower().endswith(".csv"):
            yield info, name


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def _ranges(spark: SparkSession, path: str | Sequence[str], path_glob: str) -> DataFrame:
    """(path, name, size, first, last, error): runs of CSV entries of each archive, or why it cannot be opened."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    with open_binary(r.path) as f, zipfile.ZipFile(f) as archive:
                        sizes = [i.file_size for i, _ in _csv_entries(archive)]
                except BROKEN as e:
                    rows.append((r.path, r.name, r.size, 0, 0, f"{type(e).__name__}: {e}"))
                    continue
                first = total = 0
                for i, size in enumerate(sizes):
                    if i > first and (i - first >= RANGE_ENTRIES or total + size > RANGE_BYTES):
                        rows.append((r.path, r.name, r.size, first, i, None))
                        first, total = i, 0
                    total += size
                if sizes:
                    rows.append((r.path, r.name, r.size, first, len(sizes), None))
            yield pd.DataFrame(rows, columns=["path", "name", "size", "first", "last", "error"])

    files = list_files(spark, path, path_glob)
    return files.mapInPandas(find, "path string, name string, size bigint, first bigint, last bigint, error string")


@dataclass(frozen=True)
class ArchiveScan:
    """What one pass over archives found; ``table`` is written, and read by all that follows."""

    table: DataFrame

    @property
    def catalogue(self) -> DataFrame:
        """One row per CSV member, or per archive that cannot be opened."""
        return self.table.where("block IS NULL").select(*CATALOGUE)

    @property
    def report(self) -> DataFrame:
        """(archive, member, encoding, confidence) of each member whose name ends in ``.csv``; confidence is
        the share of bytes that decode, null with the encoding for members that cannot be read."""
        members = self.table.where(F.col("block").isNull() & F.col("entry").endswith(".csv"))
        return members.select("archive", "member", F.col("report_encoding").alias("encoding"), "confidence")

    @property
    def blocks(self) -> DataFrame:
        return self.table.where("block IS NOT NULL").select(file_id().alias("file_id"), "first_line", "data")


def scan_archives(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = ENCODINGS, path_glob: str = "*.zip") -> ArchiveScan:
    """Read every CSV member of every archive below ``path`` once.

    Members are told apart by (path, offset), so equal names never overwrite
    each other. An archive that cannot be opened is one row without an entry; it
    and unreadable members carry the reason in ``error`` and have no encoding.
    """
    # Few bytes but much work per row: an explicit count keeps adaptive
    # execution from merging all ranges into one task.
    ranges = _ranges(spark, path, path_glob).repartition(_tasks(spark), "path", "first")
    names = [f.split()[0] for f in SCANNED.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.binary()]

    def batch(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for todo in batches:
            for r in todo.to_pylist():
                if r["error"] is not None:
                    yield batch((r["path"], r["name"], 0, None, -1, None, r["size"], r["error"], *[None] * 7))
                    continue
                with open_binary(r["path"]) as f, zipfile.ZipFile(f) as archive:
                    for info, name in list(_csv_entries(archive))[r["first"] : r["last"]]:
                        member = (r["path"], r["name"], r["first"], info.filename, info.header_offset, name.replace("\\", "/").rsplit("/", 1)[-1], info.file_size)
                        for found in _scanned(archive, info, encodings):
                            yield batch((*member, *found))

    shared_dir(spark)
    return ArchiveScan(materialise(ranges.mapInArrow(scan, SCANNED), "members"))


def _scanned(archive: zipfile.ZipFile, info: zipfile.ZipInfo, encodings: Sequence[str]) -> Iterator[tuple]:
    """The member's blocks as they are inflated, then its own row."""
    trial = Decoders(dict.fromkeys([*encodings, *REPORT_ENCODINGS]))
    lines = LineBlocks()
    nothing = (None,) * 4
    try:
        with archive.open(info) as member:
            for piece in pieces_of(member):
                trial.feed(piece)
                for block in lines.feed(piece):
                    yield None, *nothing, *block
        trial.feed(b"", True)
        for block in lines.rest():
            yield None, *nothing, *block
        encoding = next((e for e in encodings if e in trial.alive), None)
        report = next(((e, 1.0) for e in REPORT_ENCODINGS if e in trial.alive), None)
        if report is None:
            # Nothing decodes it whole: the shares need its bytes once more.
            with archive.open(info) as member:
                report = guess_encoding(pieces_of(member))
    except BROKEN as e:
        yield f"{type(e).__name__}: {e}", *nothing, None, None, None
        return
    header = None if encoding is None else header_cells(lines.header.decode(encoding))
    yield "no encoding decodes it" if encoding is None else None, encoding, header, *report, None, None, None


class Decoders:
    """Encodings that have decoded all bytes so far."""

    def __init__(self, encodings: Iterable[str]):
        self.alive = {e: codecs.getincrementaldecoder(e)() for e in encodings}

    def feed(self, data: bytes, last: bool = False) -> None:
        for e in list(self.alive):
            try:
                self.alive[e].decode(data, last)
            except UnicodeDecodeError:
                del self.alive[e]


class LineBlocks:
    """Cuts a stream of bytes into blocks of whole lines: (number, number of the first line, data).

    Line ends become line feeds, which none of the encodings uses inside a character.
    The first line that is not blank is the header; lines are counted from 1 after it.
    """

    def __init__(self):
        self.header = b""
        self.headed = False
        self.kept, self.number, self.line = bytearray(), 0, 1

    def feed(self, piece: bytes) -> Iterator[tuple[int, int, bytes]]:
        self.kept += piece
        if len(self.kept) >= BLOCK_BYTES:
            end = self.kept.rfind(b"\n") + 1
            if not end:
                # Lines may end in a carriage return alone; one at the very end may have its line feed yet to come.
                end = self.kept.rfind(b"\r", 0, len(self.kept) - 1) + 1
            if end:
                data = bytes(self.kept[:end])
                del self.kept[:end]
                yield from self._block(data)

    def rest(self) -> Iterator[tuple[int, int, bytes]]:
        data, self.kept = bytes(self.kept), bytearray()
        yield from self._block(data)

    def _block(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        data = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
        while not self.headed and data:
            line, _, data = data.partition(b"\n")
            if line.strip():
                self.header, self.headed = line, True
        if data:
            lines = data.count(b"\n") + (not data.endswith(b"\n"))
            yield self.number, self.line, data.removesuffix(b"\n")
            self.number += 1
            self.line += lines


def zip_catalogue(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = ENCODINGS, path_glob: str = "*.zip") -> DataFrame:
    """One row per CSV member of every archive below ``path``; see :func:`scan_archives`."""
    return scan_archives(spark, path, encodings, path_glob).catalogue


def encoding_report(spark: SparkSession, path: str | Sequence[str], path_glob: str = "*.zip") -> DataFrame:
    """(archive, member, encoding, confidence) from all bytes of each member; see :class:`ArchiveScan`."""
    return scan_archives(spark, path, path_glob=path_glob).report


def guess_encoding(pieces: Iterable[bytes]) -> tuple[str, float]:
    """First encoding under which the most bytes decode, and their share.

    One pass with all decoders side by side.
    """
    strict = {e: codecs.getincrementaldecoder(e)() for e in REPORT_ENCODINGS}
    lenient = {e: codecs.getincrementaldecoder(e)("ignore") for e in REPORT_ENCODINGS}
    kept, total = dict.fromkeys(REPORT_ENCODINGS, 0), 0

    def feed(data: bytes, last: bool) -> None:
        for e in REPORT_ENCODINGS:
            kept[e] += len(lenient[e].decode(data, last).encode(e, "ignore"))
            if e in strict:
                try:
                    strict[e].decode(data, last)
                except UnicodeDecodeError:
                    del strict[e]

    for piece in pieces:
        total += len(piece)
        feed(piece, False)
    feed(b"", True)
    if strict:
        return next(iter(strict)), 1.0
    best = max(REPORT_ENCODINGS, key=lambda e: kept[e])
    return best, kept[best] / total


def _decoding(data: list[bytes], encoding: str) -> list[bool]:
    """Which of the lines decode: all at once, else in halves."""
    try:
        b"\n".join(data).decode(encoding)
    except UnicodeDecodeError:
        half = len(data) // 2
        return [False] if len(data) == 1 else _decoding(data[:half], encoding) + _decoding(data[half:], encoding)
    return [True] * len(data)


def columns_of(catalogue: DataFrame) -> list[str]:
    """All column names of the catalogued files, in order of first appearance
    by member name. Bounded by the distinct headings."""
    named = catalogue.select("member", F.posexplode("header").alias("pos", "name"))
    firsts = named.groupBy("name").agg(F.min(F.struct("member", "pos")).alias("at"))
    return [r["name"] for r in firsts.orderBy("at").collect()]


def _positions(columns: Sequence[str]) -> Column:
    """1-based place of each output column in the file's header, 0 if absent."""
    return F.array(*[F.coalesce(F.array_position("header", c), F.lit(0)).cast("int") for c in columns])


def _cells(lines: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Split text lines into the output columns."""
    split = lines.where(F.trim("line") != "").withColumn("__cells", F.split("line", ",", -1))
    fitting = split.where(F.size("__cells") <= F.col("width"))
    made = []
    for i, c in enumerate(columns):
        at = F.col("positions")[i]
        cell = F.when(at > 0, F.try_element_at("__cells", at))
        made.append(F.when(~cell.isin(*MISSING), cell).alias(c))
    return fitting.select(*[col(k) for k in keep], *made)


def read_zip_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    encodings: Sequence[str] = ENCODINGS,
    path_glob: str = "*.zip",
) -> DataFrame:
    """All CSV members below ``path`` as one text table with ``archive`` and
    ``source_file``; differing columns are united, missing ones null.

    Without ``columns`` the headers are gathered first. Members that none of the
    encodings decodes are left out; the catalogue shows them.
    """
    return zip_table(scan_archives(spark, path, encodings, path_glob), columns)


def zip_table(scan: ArchiveScan, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of the scanned members as one text table."""
    columns = columns_of(scan.catalogue) if columns is None else list(columns)
    lines = _lines_of(scan, "archive", F.col("member").alias(SOURCE), F.size("header").alias("width"), _positions(columns).alias("positions"))
    return _cells(lines, columns, ["archive", SOURCE])


def file_id() -> Column:
    """Key of a scanned member: its archive and its place in it."""
    return F.concat("path", F.lit("#"), F.col("offset").cast("string"))


def zip_lines(scan: ArchiveScan) -> DataFrame:
    """Text lines after the header of every readable member: (file_id, line_no, line)."""
    return _lines_of(scan).select("file_id", "line_no", "line")


def _lines_of(scan: ArchiveScan, *of_file: str | Column) -> DataFrame:
    """Lines with columns of their member: (file_id, line_no, line, …)."""
    readable = scan.catalogue.where(F.col("encoding").isNotNull())
    files = readable.select(file_id().alias("file_id"), "encoding", *of_file)
    blocks = lookup_join(scan.blocks, files, ["file_id"], "inner")
    # UTF-8 needs no Python: the catalogue says that all bytes are valid.
    text = F.when(F.col("encoding") == "utf-8", F.col("data").cast("string")).otherwise(_decode(F.when(F.col("encoding") != "utf-8", F.col("data")), F.col("encoding")))
    cut = blocks.withColumn("text", text).select("*", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return cut.withColumn("line_no", F.col("first_line") + F.col("at")).drop("data", "text", "first_line", "at", "encoding")


def zip_rejects(scan: ArchiveScan) -> DataFrame:
    """Lines that reading skips because they have too many fields:
    (archive, source_file, line_no, line)."""
    lines = _lines_of(scan, "archive", F.col("member").alias(SOURCE), F.size("header").alias("width"))
    return lines.where(F.size(F.split("line", ",", -1)) > F.col("width")).select("archive", SOURCE, "line_no", "line")


def family_columns(scan: ArchiveScan) -> DataFrame:
    """(family, columns): the united column names of the readable members of each family, in order of first appearance by member name."""
    readable = group_file_family(scan.catalogue.where(F.col("encoding").isNotNull()), "member")
    named = readable.select("family", "member", F.posexplode("header").alias("pos", "name"))
    firsts = named.groupBy("family", "name").agg(F.min(F.struct("member", "pos")).alias("at"))
    in_order = F.sort_array(F.collect_list(F.struct("at", "name")))
    return firsts.groupBy("family").agg(F.transform(in_order, lambda x: x["name"]).alias("columns"))


def zip_families(scan: ArchiveScan, columns: DataFrame) -> DataFrame:
    """(family, source_file, cells) of every line: its cells in the order of its family's ``columns``.

    One table for any number of families, to be written partitioned by family;
    :func:`family_table` names the cells again.
    """
    files = group_file_family(scan.catalogue.where(F.col("encoding").isNotNull()), "member").select(file_id().alias("placed"), "family", "header")
    places = lookup_join(files, columns, ["family"], "inner").select(
        "placed", "family", F.size("header").alias("width"), F.transform("columns", lambda c: F.coalesce(F.array_position(F.col("header"), c), F.lit(0)).cast("int")).alias("positions")
    )
    lines = lookup_join(_lines_of(scan, F.col("member").alias(SOURCE)).withColumnRenamed("file_id", "placed"), places, ["placed"], "inner")
    split = lines.where(F.trim("line") != "").withColumn("fields", F.split("line", ",", -1)).where(F.size("fields") <= F.col("width"))

    def cell(at: Column) -> Column:
        value = F.when(at > 0, F.try_element_at("fields", at))
        return F.when(~value.isin(*MISSING), value)

    return split.select("family", SOURCE, F.transform("positions", cell).alias("cells"))


def family_table(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of one family with a column for each of its names."""
    return rows.select(SOURCE, *(F.col("cells")[i].alias(c) for i, c in enumerate(columns)))


def extract_members(catalogue: DataFrame, folder: str) -> DataFrame:
    """Copy every readable member, byte for byte, and return (archive, member,
    target, size). The copy is made when the result is used; ``read_legacy_csv``
    can then read the folder in pieces.

    The target ``folder/{archive}-{hash of its path}/{offset}/{member}`` differs
    for every member, however often names repeat.
    """
    folder = qualified(catalogue.sparkSession, folder)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            targets: dict[int, str] = {}
            # The directory of an archive is read once for all of its members here.
            for (path, name), members in batch.groupby(["path", "archive"], sort=False):
                mark = hashlib.blake2b(path.encode(), digest_size=8).hexdigest()
                with open_binary(path) as f, zipfile.ZipFile(f) as archive:
                    # By place, since an archive may hold a name twice.
                    at = {i.header_offset: i for i in archive.infolist()}
                    for r in members.itertuples():
                        targets[r.Index] = f"{folder}/{name.rsplit('.', 1)[0]}-{mark}/{r.offset}/{r.member}"
                        with archive.open(at[r.offset]) as member:
                            write_binary(targets[r.Index], pieces_of(member))
            yield batch[["archive", "member", "size"]].assign(target=pd.Series(targets))[["archive", "member", "target", "size"]]

    todo = catalogue.where(F.col("encoding").isNotNull()).select("path", "archive", "part", "offset", "member", "size")
    dealt = todo.repartition(_tasks(catalogue.sparkSession), "path", "part").sortWithinPartitions("path", "part")
    return dealt.mapInPandas(copy, "archive string, member string, target string, size bigint")


def _raw_lines(spark: SparkSession, path: str | Sequence[str], path_glob: str) -> DataFrame:
    """Lines after the header of plain files as (key, raw), one char per byte."""
    return (
        spark.read.schema("raw string")
        .option("header", "true")
        .option("encoding", "ISO-8859-1")
        .option("sep", "\u0001\u0002\u0003")
        .option("quote", "")
        .option("escape", "")
        .option("pathGlobFilter", path_glob)
        .option("recursiveFileLookup", "true")
        .csv([path] if isinstance(path, str) else list(path))
        .select(F.col("_metadata.file_path").alias("key"), "raw")
    )


@F.pandas_udf(T.IntegerType())
def _decodable(raw: pd.Series, encodings: pd.Series) -> pd.Series:
    """Bit i is set when the bytes decode under the i-th encoding."""
    known = raw.notna().to_numpy()
    data, bits = [bytes(d) for d in raw[known]], np.full(len(raw), -1, dtype=np.int32)
    if data:
        tried = encodings.iloc[0].split(",")
        bits[known] = sum(np.array(_decoding(data, e)).astype(np.int32) << i for i, e in enumerate(tried))
    return pd.Series(bits)


@F.pandas_udf(T.StringType())
def _decode(raw: pd.Series, encoding: pd.Series) -> pd.Series:
    """The lines or blocks of one encoding are decoded together."""
    out = np.full(len(raw), None, dtype=object)
    known = np.flatnonzero(raw.notna().to_numpy())
    for e in encoding.iloc[known].unique():
        at = known[(encoding.iloc[known] == e).to_numpy()]
        data = [bytes(d) for d in raw.iloc[at]]
        pieces = b"\x00".join(data).decode(e).split("\x00")
        # A line may hold the character that joins them.
        out[at] = pieces if len(pieces) == len(data) else [d.decode(e) for d in data]
    return pd.Series(out, dtype=object)


NON_ASCII = "[\u0080-\u00ff]"


def csv_catalogue(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = ENCODINGS, path_glob: str = "*.csv") -> DataFrame:
    """One row per plain CSV file below ``path``, in the shape of
    :func:`zip_catalogue` (without archive)."""
    files = list_files(spark, path, path_glob).repartition(_tasks(spark), "path")
    headed = files.mapInPandas(_first_lines, "path string, key string, name string, size bigint, head binary")
    if len(encodings) == 1:
        # Nothing to choose, so no pass over the lines; bytes that do not decode
        # fail the read.
        found = headed.withColumn("encoding", F.lit(encodings[0]))
    else:
        found = headed.join(_file_encodings(spark, path, encodings, path_glob), "key", "left")
        # A file of one line, its header, has no bits.
        found = found.withColumn("encoding", _first_encoding(F.coalesce("bits", F.lit(-1)), F.col("head"), encodings))
    header = _header_of(F.col("head"), F.col("encoding"))
    return found.select(
        "path", "key", F.lit(None).cast("string").alias("archive"), F.col("name").alias("member"), "size", "encoding", header.alias("header")
    )


def _file_encodings(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str], path_glob: str) -> DataFrame:
    """(key, bits): the encodings that decode every line of a file, as bits."""
    # Only lines with a non-ASCII byte are worth a trial.
    suspect = F.when(F.col("raw").rlike(NON_ASCII), F.encode("raw", "ISO-8859-1"))
    tried = _raw_lines(spark, path, path_glob).select("key", _decodable(suspect, F.lit(",".join(encodings))).alias("bits"))
    return tried.groupBy("key").agg(F.bit_and("bits").alias("bits"))


def _first_encoding(bits: Column, head: Column, encodings: Sequence[str]) -> Column:
    both = bits.bitwiseAND(_decodable(head, F.lit(",".join(encodings))))
    return F.coalesce(*[F.when(both.bitwiseAND(1 << i) != 0, F.lit(e)) for i, e in enumerate(encodings)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _header_of(head: pd.Series, encoding: pd.Series) -> pd.Series:
    return pd.Series(
        [None if h is None or e is None else header_cells(bytes(h).decode(e)) for h, e in zip(head, encoding, strict=True)], dtype=object
    )


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads = []
        for path in batch["path"]:
            with open_binary(path) as f:
                heads.append(_first_line(io.BufferedReader(f)))
        yield batch.assign(head=heads)


def read_legacy_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    encodings: Sequence[str] = ENCODINGS,
    path_glob: str = "*.csv",
) -> DataFrame:
    """All plain CSV files below ``path`` as one text table with ``source_file``.

    Files that no encoding decodes and lines with too many fields are left out;
    ``csv_catalogue`` (no encoding) and ``csv_rejects`` show them.
    """
    shared_dir(spark)
    catalogue = csv_catalogue(spark, path, encodings, path_glob).checkpoint()
    columns = columns_of(catalogue) if columns is None else list(columns)
    return _cells(_csv_lines(spark, path, catalogue, _positions(columns).alias("positions"), path_glob), columns, [SOURCE])


def csv_rejects(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str] = ENCODINGS, path_glob: str = "*.csv") -> DataFrame:
    """Lines that ``read_legacy_csv`` skips because they have too many fields:
    (source_file, line)."""
    shared_dir(spark)
    catalogue = csv_catalogue(spark, path, encodings, path_glob).checkpoint()
    lines = _csv_lines(spark, path, catalogue, F.lit(None).alias("positions"), path_glob)
    return lines.where(F.size(F.split("line", ",", -1)) > F.col("width")).select(SOURCE, "line")


def _csv_lines(spark: SparkSession, path: str | Sequence[str], catalogue: DataFrame, positions: Column, path_glob: str) -> DataFrame:
    files = catalogue.where(F.col("encoding").isNotNull()).select(
        "key", F.col("member").alias(SOURCE), "encoding", F.size("header").alias("width"), positions
    )
    lines = lookup_join(_raw_lines(spark, path, path_glob), files, ["key"], "inner")
    odd = F.when(F.col("raw").rlike(NON_ASCII), F.encode("raw", "ISO-8859-1"))
    return lines.withColumn("line", F.coalesce(_decode(odd, F.col("encoding")), F.col("raw")))


def group_file_family(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """Add ``family`` (file stem without a trailing four-digit year, in any script's digits) and
    ``year`` (last four characters of the stem, the order within a family)."""
    stem = F.regexp_replace(F.element_at(F.split(col(source), "/"), -1), r"(?<=.)\.[^.]*$", "")
    return df.withColumns({"family": F.regexp_replace(stem, r"\p{Nd}{4}$", ""), "year": F.substring(stem, -4, 4)})
