"""Quality classifier from weak labels.

Simple labellers look at a text and vote good, bad or nothing. Expectation
maximisation estimates each labeller's accuracy from how they agree, without any
true label, over the votes of all documents. The posteriors label a bounded
sample, on which a linear scorer over hashed features is trained; it then scores
every document, also where all labellers abstain.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import DOCUMENT_COLUMNS, id_and_text, list_array

FEATURES = 1 << 12
SAMPLE = 8192  # texts the scorer is trained on, about
KEEP = 0.5  # smallest score that stays
FALSE_ALARMS = 0.002  # prior share of good texts that a labeller calls bad
BAD_SHARE = 0.1  # balance of the classes
SEED = 7

_SHAPE = bytearray(range(256))
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58] = b"X" * 26, b"x" * 26, b"9" * 10
_SHAPE[0xC0:0x100] = b"x" * 64  # first byte of a letter outside ASCII, mostly
_LATER = bytes(range(0x80, 0xC0))
_RUNS = re.compile(rb"(x)x+|(X)X+|(9)9+")
_MARKS = b"#*$%&|<>{}[]=\\^~_@"
#: Upper-case letters of UTF-8 in the range U+00C0 to U+00DE, second byte.
_UPPER_LATIN = re.compile(rb"\xc3[\x80-\x9e]")

LABELLERS = ("capitals", "symbols", "repeats", "lines", "shouting", "lengths", "sentences", "copies")


class Facts:
    """What labellers and features look at."""

    def __init__(self, text: str | None):
        raw = (text or "").encode()
        self.words = raw.split()
        self.n = len(self.words)
        self.chars = max(1, sum(map(len, self.words)))
        shaped = raw.translate(bytes(_SHAPE), _LATER)
        upper, lower = shaped.count(b"X"), shaped.count(b"x")
        latin = len(_UPPER_LATIN.findall(raw))
        self.capitals = (upper + latin) / max(1, upper + lower)
        self.marks = sum(raw.count(bytes([m])) for m in _MARKS)
        self.shouts = raw.count(b"!")
        self.ends = raw.count(b".") + raw.count(b"?")
        self.distinct = len(set(self.words)) / max(1, self.n)
        self.same_as_last = sum(map(bytes.__eq__, self.words, self.words[1:])) / max(1, self.n - 1)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        self.lines = len(lines)
        self.copied_lines = 1 - len(set(lines)) / max(1, len(lines))
        self.shapes = Counter(_RUNS.sub(rb"\1\2\3", shaped).split())


def votes(f: Facts) -> list[int]:
    """1 good, -1 bad, 0 nothing, in the order of LABELLERS. A text without words gets no vote."""
    if not f.n:
        return [0] * len(LABELLERS)
    mean = f.chars / f.n
    top = f.shapes.most_common(1)[0][1] / f.n if f.n >= 20 else None

    def vote(bad: bool, good: bool) -> int:
        return -1 if bad else 1 if good else 0

    return [
        vote(f.capitals > 0.5, f.capitals < 0.2),
        vote(f.marks > 0.3 * f.n, f.marks <= 0.05 * f.n),
        vote(f.n >= 20 and f.same_as_last > 0.2, f.n >= 20 and f.same_as_last < 0.05),
        vote(f.lines >= 6 and f.copied_lines > 0.5, f.n >= 20 and f.copied_lines < 0.1),
        vote(f.shouts > 0.3 * f.n, f.shouts <= 0.05 * f.n),
        vote(mean < 2 or mean > 20, 3 <= mean <= 12),
        vote(f.n >= 40 and f.ends == 0, f.n >= 10 and 0.02 * f.n <= f.ends <= 0.5 * f.n),
        vote(f.n >= 100 and f.distinct < 0.1, f.n >= 20 and f.distinct > 0.3) if top is None or top < 0.98 else 0,
    ]


def features(f: Facts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes with their shares, and coarse steps of the shares above."""
    found: Counter[int] = Counter()
    for shape, n in f.shapes.items():
        found[zlib.crc32(shape[:12]) % FEATURES] += n / f.n
    size = min(12, f.n.bit_length())
    for name in ("capitals", "distinct", "same_as_last", "copied_lines"):
        found[zlib.crc32(f"{name}:{int(10 * getattr(f, name))}".encode()) % FEATURES] += 1
    for name in ("marks", "shouts", "ends"):
        found[zlib.crc32(f"{name}:{min(10, int(10 * getattr(f, name) / max(1, f.n)))}".encode()) % FEATURES] += 1
    found[zlib.crc32(f"size:{size}".encode()) % FEATURES] += 1
    places = sorted(found)
    return np.array(places, dtype=np.int64), np.array([found[p] for p in places])


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good for each vote pattern, accuracy of each labeller).

    ``patterns`` are rows of votes. Given the class, labellers are taken to err
    independently, each with its own rate of wrong votes in either class; not to
    vote says nothing. A labeller that looks for one fault cannot confirm the
    others', so the data alone would outvote it: a strong prior says that it seldom
    accuses a good text, and good votes, which mostly mean that nothing was found,
    count half. The balance of the classes is given, not fitted. The start believes every bad vote.
    """
    good = np.where((patterns == -1).any(axis=1), 0.05, 0.95)
    bad_vote, good_vote = (patterns == -1).astype(float), (patterns == 1).astype(float)
    for _ in range(rounds):
        score = np.zeros(len(patterns))
        for weight, sign, prior_bad, prior_all in ((good * counts, 1, FALSE_ALARMS, 10 * counts.sum()), ((1 - good) * counts, -1, 0.5, 2.0)):
            said_bad, said_good = weight @ bad_vote, weight @ good_vote
            rate = (said_bad + prior_bad * prior_all) / (said_bad + said_good + prior_all)
            score += sign * (bad_vote @ np.log(rate) + 0.5 * good_vote @ np.log(1 - rate))
        new = 1 / (1 + np.exp(-np.clip(score + np.log((1 - BAD_SHARE) / BAD_SHARE), -30, 30)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    right = (good * counts) @ good_vote + ((1 - good) * counts) @ bad_vote
    return good, right / np.maximum(1e-9, counts @ (good_vote + bad_vote))


def train_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 30, rate: float = 0.3, penalty: float = 1e-4) -> np.ndarray:
    """Weights and bias of a logistic scorer on soft targets; classes weigh equally."""
    weights, grown = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    share = np.clip(target.mean(), 0.02, 0.98)
    order = np.random.Generator(np.random.PCG64(SEED))
    ends = np.cumsum([0, *(len(p) for p, _ in rows)])
    places = np.concatenate([p for p, _ in rows]) if rows else np.zeros(0, np.int64)
    values = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    for _ in range(epochs):
        for batch in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 256)):
            if not len(batch):
                continue
            at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in batch])
            row = np.repeat(np.arange(len(batch)), ends[batch + 1] - ends[batch])
            margin = np.bincount(row, values[at] * weights[places[at]], len(batch)) + weights[-1]
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target[batch]
            error *= np.where(target[batch] > 0.5, 0.5 / share, 0.5 / (1 - share))
            step = np.bincount(places[at], values[at] * error[row], FEATURES + 1) / len(batch) + penalty * weights
            step[-1] = error.mean()
            grown += step * step
            weights -= rate * step / np.sqrt(grown)
    return weights


def scores_of(weights: np.ndarray, text: Column) -> Column:
    """Score from 0 to 1 of a text column; a text without words scores 0."""

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for x in column:
                f = Facts(x.as_py())
                places, values = features(f)
                out.append(float(1 / (1 + np.exp(-np.clip(values @ weights[places] + weights[-1], -30, 30)))) if f.n else 0.0)
            yield pa.array(out, type=pa.float64())

    return score(text)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, dict[str, float]]:
    """(weights of the scorer, accuracy of each labeller).

    Votes are counted over all documents; only ``sample`` different texts, chosen
    by hash, are trained on. Without a document with words all weights are 0.
    """
    docs = id_and_text(docs, id_col, text_col)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[int] = Counter()
            for x in batch.column(0):
                f = Facts(x.as_py())
                if f.n:
                    seen[sum((v + 1) * 3**i for i, v in enumerate(votes(f)))] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"])

    counted = docs.select("text").mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()  # at most 3 ** labellers
    if not counted:
        return np.zeros(FEATURES + 1), dict.fromkeys(LABELLERS, 0.0)
    codes = np.array([r.pattern for r in counted])
    patterns = codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1
    good, accuracy = expectation_maximisation(patterns, np.array([r.n for r in counted], dtype=float))
    posterior = dict(zip(codes.tolist(), good.tolist()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places, values = [], [], []
            for x in batch.column(1):
                f = Facts(x.as_py())
                p, v = features(f)
                names.append(sum((v + 1) * 3**i for i, v in enumerate(votes(f))) if f.n else None)
                places.append(p)
                values.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), list_array(places, pa.int64()), list_array(values, pa.float64())], names=["h", "pattern", "places", "values"])

    hashed = docs.select(F.pmod(F.xxhash64("text"), F.lit(1 << 40)).alias("h"), "text")
    different = max(1, hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0])
    chosen = hashed.where(F.col("h") < int(min(1.0, sample / different) * (1 << 40)) + 1)
    chosen = chosen.groupBy("h").agg(F.min("text").alias("text"))  # copies once
    rows = sorted(chosen.mapInArrow(describe, "h long, pattern long, places array<long>, values array<double>").where("pattern is not null").collect(), key=lambda r: r.h)
    weights = train_linear([(np.array(r.places), np.array(r.values)) for r in rows], np.array([posterior[r.pattern] for r in rows]))
    return weights, dict(zip(LABELLERS, accuracy.tolist()))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, kept) of every row; texts without words score 0 and go."""
    weights, _ = fit(docs, id_col, text_col, sample)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), scores_of(weights, F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("kept", F.col("score") >= keep)


def good_documents(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """The documents that score ``keep`` or more, as they are."""
    weights, _ = fit(docs)
    return docs.select(DOCUMENT_COLUMNS).where(scores_of(weights, F.col("text")) >= keep)
