"""Opening files from inside tasks, on any storage Arrow has a client for."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import BinaryIO

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Encodings tried, in this order.
ENCODINGS = ("utf-8", "shift_jis", "cp932", "euc_jp")

PIECE = 1 << 20


def _resolve(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@contextmanager
def open_binary(path: str) -> Iterator[BinaryIO]:
    """A seekable stream; the file is never held in memory as a whole."""
    filesystem, inner = _resolve(path)
    with filesystem.open_input_file(inner) as stream:
        yield stream


def write_binary(path: str, pieces: Iterator[bytes]) -> None:
    """Written under a hidden name, then renamed: a second attempt of a task
    replaces the file and readers never meet half of it."""
    filesystem, inner = _resolve(path)
    folder, name = inner.rsplit("/", 1)
    filesystem.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}.part"
    with filesystem.open_output_stream(part) as out:
        for piece in pieces:
            out.write(piece)
    filesystem.move(part, inner)


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str) -> DataFrame:
    """(path, key, name, size) of the files below ``path``; contents are not read.

    ``key`` is the address in the form other readers report it.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load([path] if isinstance(path, str) else list(path))
    )
    return files.select(
        "path", F.col("_metadata.file_path").alias("key"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size")
    )


def pieces_of(stream: BinaryIO) -> Iterator[bytes]:
    while piece := stream.read(PIECE):
        yield piece


def member_name(info: zipfile.ZipInfo) -> str:
    """Entry name; names without the UTF-8 flag are taken to be Japanese."""
    name = info.filename
    if not info.flag_bits & 0x800:
        try:
            name = name.encode("cp437").decode("cp932")
        except UnicodeError:
            pass
    return name
