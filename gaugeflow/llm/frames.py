"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a filtering stage of the pipeline returns.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): whatever else the table holds cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One output batch for each input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few rows at once: a batch of long texts must not fill the worker.
            for start in range(0, batch.num_rows, 2000):
                yield f(batch.slice(start, 2000))

    return df.mapInArrow(run, schema)


def binary_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def list_array(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from numpy arrays, without Python objects per element."""
    ends = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))
