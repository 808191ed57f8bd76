"""Near-duplicate documents by exact Jaccard similarity of their shingle sets.

A parity-sketch join. Sets are laid out in size bands; a band cuts the hash space
into blocks, and the shingles of a block are XORed into one 64-bit word. Changing
one shingle changes one word, so the number of unequal words is at most the
symmetric difference. Two sets with similarity t or more differ in at most
``(1 - t) / (1 + t) * (n + m)`` shingles; a band has more blocks than that, so at
least one word of such a pair is equal and an equi-join on words finds it. Parity
bits, as many as a set has shingles (512 at least), bound the difference again from
below, before the survivors are verified on their whole sets.

The words of two equal *empty* blocks are not joined. Bands of small sets get so
many blocks that the chance of a linked pair sharing no block with a shingle
stays below 1e-12; where that takes far more blocks than shingles, every shingle
is a word of its own and nothing can be missed.

Groups of equal sets are one node. All pairs of a group of similar sets are never
built. In rounds, every node picks one hub: for each of its words, the node of that
word that shares most words with others may be one (the original among its edited
copies), and the hub met in most words is verified. Linked nodes become components, words that hold one component only are
done, and rounds go on until one adds few links. Only what is then in different
components is compared word by word, with frequent words dealt over many tasks.

What a word holds is found by minima that are combined before the shuffle and by
joins, which adaptive execution splits; no window runs over a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.components import components, condensed, labels
from gaugeflow.llm.frames import DOCUMENT_COLUMNS, id_and_text, map_batches
from gaugeflow.llm.shingles import mix, shingle_sets
from gaugeflow.session import materialise

SHORT = 512  # parity bits that go along with a word
SKETCH = [f"s{i}" for i in range(SHORT // 64)]
MISS = 1e-12  # chance of a linked pair without a common word
FEW = 16  # rounds end when one finds less than this part of the links so far
GROUP = 2048  # members of one word compared in one task
PARTNERS = 256  # of one hub, compared in one task
FILTER_BITS = 1 << 27  # of a broadcast filter at most (16 MB); a full one lets more rows pass, and loses none
BUCKET_BITS = 1 << 15  # of one value of Spark's bitmap functions
BATCH_BYTES = 1 << 24


@dataclass(frozen=True)
class Bands:
    """Size bands for a threshold of ``percent`` / 100."""

    percent: int
    tops: np.ndarray
    blocks: np.ndarray  # 0: every shingle is a word


def size_bands(percent: int = 80, growth: float = 1.5, largest: int = 1 << 33) -> Bands:
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    tops, blocks, low, top = [], [], 1, 4
    while low <= largest:
        differ = (100 - percent) * 2 * top // (100 + percent)
        common = max(1, math.ceil(percent / 100 * low))
        # All common shingles fall into blocks that also hold a differing one: (differ / blocks) ** common.
        wide = math.ceil(differ * MISS ** (-1 / common)) if differ else 1
        tops.append(top)
        blocks.append(0 if wide > 16 * top else max(differ + 1, wide))
        low, top = top + 1, max(top + 1, int(top * growth))
    return Bands(percent, np.array(tops, dtype=np.int64), np.array(blocks, dtype=np.uint64))


def block_words(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Words of the set's own band and, if a larger partner may lie there, of the next ones."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    first = int(np.searchsorted(bands.tops, len(shingles)))
    last = int(np.searchsorted(bands.tops, len(shingles) * 100 // bands.percent))
    out = []
    for band in range(first, last + 1):
        if not bands.blocks[band]:
            out.append(mix(shingles ^ mix(np.array([band + 1], dtype=np.uint64))))
            continue
        block = ((shingles >> np.uint64(32)) * bands.blocks[band]) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        parity = np.bitwise_xor.reduceat(shingles, starts)
        out.append(mix(parity ^ mix(block[starts] + np.uint64(band << 40))))
    return np.concatenate(out).view(np.int64)


def parity_bits(shingles: np.ndarray, width: int) -> np.ndarray:
    """Bytes of ``width`` parity bits, a power of two."""
    flips = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(np.uint8))


def sketch_width(n: int) -> int:
    """Parity bits of a set: with fewer, those of large unrelated sets would differ too little."""
    return max(SHORT, 1 << max(0, n - 1).bit_length())


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The sketch with ``width`` bits, as if made from fewer bits of the hashes."""
    return np.bitwise_xor.reduce(bits.reshape(-1, width // 8), axis=0)


def _apart(x: pa.Scalar, y: pa.Scalar) -> int:
    """Unequal bits of two wide sketches, at the width of the narrower one."""
    x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in (x, y))
    width = 8 * min(len(x), len(y))
    return int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum())


def set_id(shingles: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    total = mix(shingles + np.uint64(0x1234567)).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(shingles))], dtype=np.uint64)).view(np.int64)[0])


PROFILE = "doc_id long, node long, n_shingles long, " + ", ".join(f"{s} long" for s in SKETCH) + ", wide binary"


def _profile(batch: pa.RecordBatch) -> pa.RecordBatch:
    nodes, sizes, short, wide = [], [], [], []
    for s in shingle_sets(batch.column(1)):
        bits = parity_bits(s, sketch_width(len(s)))
        nodes.append(set_id(s) if len(s) else None)
        sizes.append(len(s))
        short.append(folded(bits, SHORT).view(np.int64))
        wide.append(bits.tobytes() if 8 * len(bits) > SHORT else None)
    table = np.array(short).reshape(-1, len(SKETCH)) if short else np.zeros((0, len(SKETCH)), np.int64)
    columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *(pa.array(table[:, i]) for i in range(len(SKETCH))), pa.array(wide, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n_shingles", *SKETCH, "wide"])


def _filter_bits(keys: DataFrame, n: int) -> tuple[int, bytes]:
    """A bitmap of ``keys`` (one long column of hashes) with about 8 bits for each of ``n``, in a power of two."""
    size = min(FILTER_BITS, max(BUCKET_BITS, 1 << (8 * n).bit_length()))
    slot = F.col(keys.columns[0]).bitwiseAND(size - 1) + 1  # bits are counted from 1
    rows = keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("place")).repartition("bucket")
    bits = bytearray(size // 8)
    for bucket, part in rows.groupBy("bucket").agg(F.bitmap_construct_agg("place")).collect():
        bits[(bucket - 1) * len(part) : bucket * len(part)] = part
    return size, bytes(bits)


def _hits(size: int, bits: bytes, keys: np.ndarray) -> np.ndarray:
    slot = keys & (size - 1)
    return (np.frombuffer(bits, dtype=np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _words_of(docs: DataFrame, bands: Bands, held=None) -> DataFrame:
    """(word, node), of the words in the filter ``held`` if it is given; copies met by one task are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                nodes, words = [], [np.zeros(0, np.int64)]
                for s in shingle_sets(batch.column(1).slice(start, 500)):
                    if len(s) and (node := set_id(s)) not in seen:
                        seen.add(node)
                        found = block_words(s, bands)
                        found = found[_hits(*held.value, found)] if held else found
                        nodes.append(np.full(len(found), node, dtype=np.int64))
                        words.append(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(words)), pa.array(np.concatenate([np.zeros(0, np.int64), *nodes]))], names=["word", "node"])

    return docs.mapInArrow(run, "word long, node long")


def _shared_words(docs: DataFrame, bands: Bands) -> DataFrame:
    """(word, node, weight), each once, of the words that more than one node has; ``weight`` counts what the node shares with others.

    Texts are read twice: the first pass leaves minima only, the second sends the rows of shared words.
    """
    common = _words_of(docs, bands).groupBy("word").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    common = materialise(common.select(F.col("word").alias("common")), "common")
    held = docs.sparkSession.sparkContext.broadcast(_filter_bits(common, common.count()))
    rows = _words_of(docs, bands, held)
    shared = materialise(rows.join(common, F.col("word") == F.col("common"), "left_semi").distinct(), "words")
    counts = shared.groupBy("word").agg(F.count("*").alias("n")).withColumnRenamed("word", "counted")
    weights = shared.join(counts, F.col("word") == F.col("counted")).groupBy(F.col("node").alias("weighed")).agg(F.sum(F.col("n") - 1).alias("weight"))
    return shared.join(weights, F.col("node") == F.col("weighed")).select("word", "node", "weight")


def _possible(percent: int, apart: Column, n: Column, m: Column) -> Column:
    return (100 * n >= percent * m) & (100 * m >= percent * n) & (apart * (100 + percent) <= (100 - percent) * (n + m))


def _open_words(shared: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(word, node, weight, component, hub) of words that hold several components; ``hub`` is the node of most weight in the word."""
    if groups is None:
        state = shared.select("word", "node", "weight", F.col("node").alias("component"))
    else:
        known = groups.select(F.col("node").alias("grouped"), F.col("component").alias("group"))
        state = shared.join(known, F.col("node") == F.col("grouped"), "left").select("word", "node", "weight", F.coalesce("group", "node").alias("component"))
    stats = state.groupBy(F.col("word").alias("stated")).agg(F.max(F.struct("weight", "node", "component")).alias("hub"), F.min("component").alias("least"), F.max("component").alias("most"))
    stats = stats.where("least <> most").select("stated", F.struct("hub.node", "hub.component").alias("hub"))
    return state.join(stats, F.col("word") == F.col("stated")).select("word", "node", "weight", "component", "hub")


def _hub_pairs(state: DataFrame, nodes: DataFrame, tested: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): for every node b one hub a in another component, the one that most of its words offer."""
    offers = state.where("component <> hub.component").groupBy(F.col("node").alias("b"), F.col("hub.node").alias("a")).agg(F.count("*").alias("votes"))
    if tested is not None:
        offers = offers.join(tested, ["a", "b"], "left_anti")
    x, y = nodes.drop("wide").alias("x"), nodes.drop("wide").alias("y")
    apart = sum((F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in SKETCH[1:]), F.bit_count(F.col(f"x.{SKETCH[0]}").bitwiseXOR(F.col(f"y.{SKETCH[0]}"))))
    both = offers.join(x, F.col("b") == F.col("x.node")).join(y, F.col("a") == F.col("y.node"))
    near = both.where(_possible(percent, apart, F.col("x.n_shingles"), F.col("y.n_shingles")))
    best = near.groupBy("b").agg(F.max_by("a", F.struct("votes", -F.col("a"))).alias("a"))
    # Large sets are compared by their wide sketches before whole sets travel.
    x, y = (nodes.select(F.col("node").alias(c + "_node"), F.col("n_shingles").alias(c + "_n"), F.col("wide").alias(c + "_wide")) for c in "xy")
    found = best.join(x, F.col("b") == F.col("x_node")).join(y, F.col("a") == F.col("y_node")).select("a", "b", "x_n", "y_n", "x_wide", "y_wide")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        keep = [not (p.is_valid and q.is_valid) or _apart(p, q) * (100 + percent) <= (100 - percent) * int(s) for p, q, s in zip(batch.column(4), batch.column(5), n)]
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(found, check, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b) whose whole sets reach the threshold.

    A set goes to the bucket of every a it is compared with, a's own set first; the
    bucket of an a with very many partners is split.
    """
    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    # A filter over documents keeps the texts that no pair asks for out of the join; its false hits are joined away.
    reps = nodes.join(wanted, "node", "left_semi").select(F.xxhash64(F.col("rep")).alias("key"))
    held = spark.sparkContext.broadcast(_filter_bits(reps, 2 * pairs.count()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_hits(*held.value, batch.column(1).to_numpy())))
            for start in range(0, some.num_rows, 50):
                found = [s for s in shingle_sets(some.column(0).slice(start, 50)) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["of", "shingles"])

    sets_of = docs.select("text", F.xxhash64("doc_id").alias("key")).mapInArrow(sets, "of long, shingles binary")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select(F.col("b").alias("node"), F.col("a").alias("bucket"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"))
    hubs = parts.select(F.col("a").alias("node"), F.col("a").alias("bucket"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"))
    routed = members.union(hubs).join(sets_of, F.col("node") == F.col("of")).select("bucket", "part", "side", "node", "shingles")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, hub = None, np.zeros(0, np.uint64)
        for batch in batches:
            links: list[tuple[int, int]] = []
            for at, side, node, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                own = np.frombuffer(data.as_buffer(), dtype=np.uint64)
                if side == 0:
                    bucket, hub = at, own.copy()
                elif at == bucket:
                    place = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                    both = int((hub[place] == own).sum())
                    if 100 * both >= percent * (len(hub) + len(own) - both):
                        links.append((at, node))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = routed.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "side")
    return dealt.mapInArrow(check, "a long, b long").distinct()


def _open_pairs(state: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes in different components that share a word and may be similar.

    A word's rows come one after another; they are compared as arrays, and only the
    pairs that the sketches leave possible become rows. A frequent word becomes a
    triangle of chunk pairs, each about ``GROUP`` members a side.
    """
    counts = state.groupBy("word").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("chunks")).withColumnRenamed("word", "counted")
    chunked = state.join(counts, F.col("word") == F.col("counted")).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    cells = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda i: F.struct(F.least("chunk", i).alias("low"), F.greatest("chunk", i).alias("high"), F.when(i == F.col("chunk"), 0).when(i > F.col("chunk"), 1).otherwise(2).alias("side")),
    )
    rows = chunked.select("word", "node", "component", F.explode(cells).alias("cell")).select("word", "node", "component", "cell.*")
    rows = rows.join(nodes.select("node", "n_shingles", *SKETCH, "wide"), "node")

    def compare(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        node, component, n, side = (table.column(c).to_numpy() for c in ("node", "component", "n_shingles", "side"))
        bits = np.column_stack([table.column(s).to_numpy() for s in SKETCH]).view(np.uint64)
        wide = table.column("wide").combine_chunks()
        ends = np.repeat(np.append(starts[1:], len(node)), np.diff(np.append(starts, len(node))))
        first, second, i, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(node)), 0
        # Each row with the next of its group, then with the one after that, all groups at once.
        while len(i):
            step += 1
            i = i[i + step < ends[i]]
            j = i + step
            # Inside a chunk both sides are 0; between two chunks they are 1 and 2.
            ok = np.isin(side[i] + side[j], (0, 3)) & (component[i] != component[j]) & (100 * n[j] >= percent * n[i]) & (100 * n[i] >= percent * n[j])
            a, b = i[ok], j[ok]
            most = (100 - percent) * (n[a] + n[b])
            near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) * (100 + percent) <= most
            for k in np.flatnonzero(near & (n[a] > SHORT) & (n[b] > SHORT)).tolist():
                near[k] = _apart(wide[int(a[k])], wide[int(b[k])]) * (100 + percent) <= most[k]
            first.append(node[a[near]])
            second.append(node[b[near]])
        x, y = np.concatenate(first), np.concatenate(second)
        found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            if not table.num_rows:
                continue
            key = np.column_stack([table.column(c).to_numpy() for c in ("word", "low", "high")])
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            # The last group may go on in the next batch.
            held = table.slice(int(starts[-1]))
            if len(starts) > 1:
                yield compare(table.slice(0, int(starts[-1])), starts[:-1])
        if held is not None:
            yield compare(held, np.zeros(1, np.int64))

    dealt = rows.repartition("word", "low", "high").sortWithinPartitions("word", "low", "high")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def similar_pairs(docs: DataFrame, nodes: DataFrame, bands: Bands) -> DataFrame:
    """Links (a, b) of nodes that make the components of all pairs that reach the threshold.

    Between rounds the links are condensed only, which may leave a component with
    several labels: that costs comparisons and loses nothing.
    """
    percent, links, groups, tested, n_links = bands.percent, None, None, None, 0
    shared = _shared_words(docs, bands)
    while True:
        state = materialise(_open_words(shared, groups), "open")
        pairs = materialise(_hub_pairs(state, nodes, tested, percent), "pairs")
        found = materialise(_verified(pairs, docs, nodes, percent), "links")
        n_found = found.count()
        if not n_found:
            break
        links = condensed(found if links is None else links.union(found))
        tested = pairs if tested is None else tested.union(pairs)
        groups = materialise(labels(links), "groups")  # its size is known then: a small one needs no shuffle of the words
        shared = state.select("word", "node", "weight")
        n_links += n_found
        if FEW * n_found < n_links:
            state = materialise(_open_words(shared, groups), "open")
            break
    more = materialise(_open_pairs(state, nodes, percent), "pairs")
    last = _verified(more, docs, nodes, percent)
    return last if links is None else links.union(last)


def jaccard_groups(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    ``component_id`` is the smallest id reachable over links, the row's own
    included. A null or empty text, or one of white space only, has no shingles
    and is linked with nothing. Rows that repeat an id are repeated in the
    result; rows without an id are left out.
    """
    bands = size_bands(percent)
    docs = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    rows = materialise(map_batches(docs, _profile, PROFILE), "profiles")
    # Of equal sets all but the id is equal, too.
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n_shingles", *SKETCH, "wide")))
    nodes = materialise(nodes, "nodes")
    groups = materialise(components(similar_pairs(docs, nodes, bands)), "components")

    member = nodes.select("node", "rep").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    member = member.join(named, "component").select("node", "component_id")
    return rows.join(member, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each group the one with the smallest id stays.

    Repeated rows of that id, and rows without an id, stay as they are.
    """
    kept = jaccard_groups(docs, percent).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    whole = docs.where("doc_id is null").select(DOCUMENT_COLUMNS)
    return docs.select(DOCUMENT_COLUMNS).join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi").union(whole)
