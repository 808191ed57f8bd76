"""How five document filters interact in every order they can be applied.

A document's outcome in all 120 orders depends only on which filters it fails and
on its labels: 128 masks. Each mask is mapped to one wide integer with a field for
every order, step and count, so that adding integers adds all 3,600 counts at
once. Documents are counted by (part, mask) before the shuffle, and a part's
integer is the sum of its masks' integers, each times its count: at most 128 terms
a part, whatever the number of documents. A field has 64 bits, more than a table
can have rows, so no sum runs into the next field.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.frames import map_batches

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
GOOD, TOXIC = 1 << 5, 1 << 6  # bits of a mask beside the five filters'
FIELD = np.dtype("<u8")
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"


def own_failures(text: bytes, characters: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # of bytes: at space and \\x09-\\x0D only
    few = len(words) < 200
    repeated = 100 * len(set(words)) < 50 * len(words)
    loud = 100 * (len(text) - len(text.translate(None, UPPER))) > 3 * characters
    signs = len(text) != len(text.translate(None, SIGNS))
    return few | repeated << 1 | loud << 2 | signs << 3


@lru_cache(maxsize=1)
def mask_integers() -> list[int]:
    """For every mask the integer that holds its outcome in all orders and steps."""
    out = []
    for mask in range(1 << 7):
        fields = np.zeros((len(ORDERS), len(FILTERS), len(COUNTS)), dtype=FIELD)
        fails = [mask >> i & 1 for i in range(len(FILTERS))]
        for o, order in enumerate(ORDERS):
            gone = False
            for s, letter in enumerate(order):
                failing = bool(fails[FILTERS.index(letter)])
                here = failing and not gone
                redundant = failing and gone
                gone = gone or failing
                fields[o, s] = (not gone, here, redundant, failing and sum(fails) == 1, here and mask & GOOD > 0, here and mask & TOXIC > 0)
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return out


def unpacked(total: int) -> np.ndarray:
    """orders x steps x counts"""
    shape = (len(ORDERS), len(FILTERS), len(COUNTS))
    return np.frombuffer(total.to_bytes(int(np.prod(shape)) * FIELD.itemsize, "little"), FIELD).reshape(shape).astype(np.int64)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n): how many documents of a part have a mask.

    Null text is empty, null language the part of the empty string. A document without
    an id is no smaller one's copy, and rows that repeat the smallest id of a text are
    none either. Labels that repeat an id count if any of them says so.

    Copies are never brought together as rows: equal texts of a part with equal masks
    are counted before the shuffle, with their smallest id and the rows it has.
    """

    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        # As large strings: joined texts may take more than two gigabytes.
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        masks, digests = [], []
        for text, n in zip(texts, pc.utf8_length(texts).to_pylist()):
            data = text.as_buffer().to_pybytes()
            masks.append(own_failures(data, n))
            digests.append(hashlib.sha256(data).digest())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).fill_null(""), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = map_batches(rows, own, "doc_id long, part string, mask int, digest binary")
    label = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    bits = F.when(F.col("good"), GOOD).otherwise(0) + F.when(F.col("toxic"), TOXIC).otherwise(0)
    rows = rows.join(label, F.col("doc_id") == F.col("label_id"), "left").select("doc_id", "digest", "part", (F.col("mask") + bits).cast("int").alias("mask"))
    known = F.col("doc_id").isNotNull()
    one = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("c"))
    kind = one.groupBy("digest", "part", "mask").agg(F.sum("c").alias("n"), F.sum(F.when(~known, F.col("c")).otherwise(0)).alias("nameless"), F.min(F.when(known, F.struct("doc_id", "c"))).alias("least"))
    # At most one row a digest for each part and mask.
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    unique = F.col("nameless") + F.coalesce(F.when(F.col("least.doc_id") == first, F.col("least.c")), F.lit(0))
    both = kind.select("part", "mask", "n", unique.alias("unique"))
    pairs = F.array(F.struct("mask", F.col("unique").alias("n")), F.struct((F.col("mask") + (1 << 4)).cast("int").alias("mask"), (F.col("n") - F.col("unique")).alias("n")))
    return both.select("part", F.inline(pairs)).groupBy("part", "mask").agg(F.sum("n").alias("n")).where("n > 0")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part, order and step (600 rows a part); no documents give no rows."""
    schema = f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTS)}, shapley long"

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = documents = 0
        for batch in batches:  # at most one row for each mask
            for mask, n in zip(batch.column("mask").to_pylist(), batch.column("n").to_pylist()):
                total += n * mask_integers()[mask]
                documents += n
        if documents >= 1 << 8 * FIELD.itemsize:
            raise OverflowError("more documents than a field can count")
        counts = unpacked(total)
        removed = counts[:, :, COUNTS.index("removed")]
        letters = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
        shapley = np.zeros(len(FILTERS), dtype=np.int64)
        np.add.at(shapley, letters.ravel(), removed.ravel())
        n = len(ORDERS) * len(FILTERS)
        columns = [
            pa.array([key[0].as_py()] * n, pa.string()),
            pa.array(np.repeat(ORDERS, len(FILTERS)).tolist(), pa.string()),
            pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
            *(pa.array(counts[:, :, i].ravel()) for i in range(len(COUNTS))),
            pa.array(shapley[letters.ravel()]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return mask_counts(docs, labels).groupBy("part").applyInArrow(run, schema)


def oracle() -> str:
    return r"""
    WITH texts AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
      FROM documents
    ), label AS (
      SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id
    ), failing AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
                    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
                    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                    CASE WHEN texts.doc_id > first_id THEN 'E' ELSE '' END) AS fails
      FROM texts LEFT JOIN label ON texts.doc_id = label.doc_id
    ), masks AS (
      SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
    steps AS (
      SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, unnest([1, 2, 3, 4, 5]) AS step
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c
    ), outcomes AS (
      SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter, n, good, toxic, fails,
             contains(fails, substr(filter_order, step, 1)) AS failing,
             length(fails) > 0 AND regexp_matches(substr(filter_order, 1, step - 1), '[' || CASE WHEN fails = '' THEN '_' ELSE fails END || ']') AS gone
      FROM masks CROSS JOIN steps
    ), sums AS (
      SELECT part, filter_order, step, letter,
             sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN failing AND NOT gone THEN n * good ELSE 0 END) AS good_lost,
             sum(CASE WHEN failing AND NOT gone THEN n * toxic ELSE 0 END) AS toxic_lost
      FROM outcomes GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM sums
    """
