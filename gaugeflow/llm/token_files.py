"""Token ids of documents in binary files, in patched frame-of-reference blocks.

A file holds whole documents in order: a header, the blocks, the index of block
starts, the documents' ids and lengths, and a footer with the places of the parts.
A block of ``BLOCK`` ids stores its minimum, the differences to it packed at the
width that a percentile of them needs, and the differences that do not fit as
(place, value) exceptions. Any id can be read by its place: the index leads to its
block.

Tasks write their range of documents, several files each if it is long, and a
table of the files written by the tasks that succeeded; files of failed or
repeated attempts are named differently and never read. Reading back goes through
Spark's own file reader.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeflow.llm.frames import id_and_text
from gaugeflow.llm.tokens import encoder
from gaugeflow.session import fresh_path, materialise
from gaugeflow.sources.storage import write_binary

MAGIC = b"PFORIDS1"
BLOCK = 1024
PERCENTILE = 90
FILE_IDS = 4_000_000  # ids after which a file is closed

_HEAD = struct.Struct("<IHBH")  # minimum, count, width, exceptions
_FOOT = struct.Struct("<QQQQQ8s")  # block starts, documents, number of blocks, documents, ids


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of every value, most significant bit first."""
    if not width:
        return b""
    kind, whole = (">u2", 16) if width <= 16 else (">u4", 32)
    bits = np.unpackbits(values.astype(kind).view(np.uint8)).reshape(len(values), whole)
    return np.packbits(bits[:, whole - width :]).tobytes()


def unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(count, dtype=np.uint32)
    whole = 16 if width <= 16 else 32
    bits = np.zeros((count, whole), dtype=np.uint8)
    bits[:, whole - width :] = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * width).reshape(count, width)
    return np.packbits(bits).view(">u2" if whole == 16 else ">u4").astype(np.uint32)


def write_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of 1 to ``BLOCK`` ids below 2**32."""
    least = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(least)
    rank = max(0, -(-len(rest) * percentile // 100) - 1)
    width = int(np.partition(rest, rank)[rank]).bit_length()
    far = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    body = pack_bits(np.bitwise_and(rest, np.uint32((1 << width) - 1)), width)
    return _HEAD.pack(least, len(ids), width, len(far)) + far.astype("<u2").tobytes() + rest[far].astype("<u4").tobytes() + body


def read_block(data: bytes, at: int = 0) -> np.ndarray:
    least, count, width, n = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    places, values = np.frombuffer(data, "<u2", n, at), np.frombuffer(data, "<u4", n, at + 2 * n)
    at += 6 * n
    rest = unpack_bits(data[at : at + (count * width + 7) // 8], count, width)
    rest[places] = values
    return rest + np.uint32(least)


def encode_file(doc_ids: list[int | None], ids: list[bytes], percentile: int = PERCENTILE) -> bytes:
    """A whole file from the documents' ids as little-endian unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    out, starts = io.BytesIO(), []
    out.write(MAGIC)
    for at in range(0, len(flat), BLOCK):
        starts.append(out.tell())
        out.write(write_block(flat[at : at + BLOCK], percentile))
    first = out.tell()
    out.write(np.array(starts, dtype="<u8").tobytes())
    second = out.tell()
    out.write(np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes())
    out.write(np.array([len(i) // 4 for i in ids], dtype="<u8").tobytes())
    out.write(_FOOT.pack(first, second, len(starts), len(ids), len(flat), MAGIC))
    return out.getvalue()


class TokenFile:
    """Documents and ids of one file's bytes."""

    def __init__(self, data: bytes):
        first, second, blocks, docs, self.n_ids, magic = _FOOT.unpack_from(data, len(data) - _FOOT.size)
        if magic != MAGIC or data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.data = data
        self.starts = np.frombuffer(data, "<u8", blocks, first)
        missing = np.frombuffer(data, np.uint8, docs, second + 8 * docs)
        self.doc_ids = [None if m else d for d, m in zip(np.frombuffer(data, "<i8", docs, second).tolist(), missing)]
        self.ends = np.concatenate(([0], np.cumsum(np.frombuffer(data, "<u8", docs, second + 9 * docs)))).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at the places [start, stop) of the file."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, (stop - 1) // BLOCK
        run = np.concatenate([read_block(self.data, int(self.starts[i])) for i in range(a, b + 1)])
        return run[start - a * BLOCK : stop - a * BLOCK]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", percentile: int = PERCENTILE) -> DataFrame:
    """Encode and write all documents in ascending id order; returns the table of files.

    (file, task, part, n_docs, n_ids), in order by (task, part). Null text is empty,
    so such a document is its end id only. Rows without an id come first; rows that
    repeat an id follow one another, ordered by text. No rows give no files.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    end = int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, attempt, part = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        make = encoder(tokenizer)
        names, held, n = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal names, held, n, part
            name = f"{task:06d}-{part:05d}-{attempt}.ids"
            write_binary(f"{folder}/{name}", [encode_file(names, held, percentile)])
            row = pa.RecordBatch.from_pydict({"file": [name], "task": [task], "part": [part], "n_docs": [len(names)], "n_ids": [n]})
            names, held, n, part = [], [], 0, part + 1
            return row

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = make.encode(text.as_py() or "") + end
                names.append(doc.as_py())
                held.append(ids)
                n += len(ids) // 4
                if n >= FILE_IDS:
                    yield close()
        if names:
            yield close()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = docs.repartitionByRange(tasks, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return materialise(in_order.mapInArrow(write, "file string, task long, part long, n_docs long, n_ids long"), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, read back."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if files.isEmpty():
        return spark.createDataFrame([], schema)
    # One row per file: the table is tiny against the data, about one in FILE_IDS ids.
    order = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = TokenFile(data.as_buffer().to_pybytes())
                all_ids = file.ids(0, file.n_ids).astype("<u4").tobytes()
                ends = file.ends.tolist()
                crc = [zlib.crc32(all_ids[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(file.ends[:-1] + base), pa.array(np.diff(file.ends)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return content.join(placed, "file").select("base", "content").mapInArrow(read, schema)


def token_files_digest(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents below the shared folder and describe what is read back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "ids")
    return read_token_files(spark, write_token_files(docs, tokenizer, folder, end_id), folder)
