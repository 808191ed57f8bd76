"""Language of a text by compression with per-language zstandard dictionaries.

Each language's dictionary is raw content: letters of a bounded sample of its
labelled documents. A text is compressed in pieces of a fixed size, each anew with
every dictionary, so that what a dictionary saves grows with the text. The language
that needs the fewest bytes in all is chosen, and the choice is rejected when the
runner-up needs hardly more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import DOCUMENT_COLUMNS

DICTIONARY_BYTES = 128 << 10  # of letters for a language
SAMPLE_DOCS = 64  # different labelled texts for a language, about
PIECE_BYTES = 16 << 10  # of letters that are compressed together
LEVEL = 6
MIN_MARGIN = 0.004  # share of bytes by which the best must beat the second
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return _NO_LETTER.sub(" ", text.lower()).encode()


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn_dictionaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary of every language with a labelled text outside the held-out quarter.

    The sample is bounded by the constants above: whole texts with the smallest hashes,
    copies once, until the dictionary is full (none can give it more than its size). Rows without id, text or language are not learned from.
    """
    known = docs.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(text_col), F.lit(1 << 30)).alias("h"))
    sizes = {r.lang: max(1, r.n) for r in known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not sizes:
        return {}
    border = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, SAMPLE_DOCS / n) * (1 << 30)) + 1)))[F.col("lang")]
    sample = known.where(F.col("h") < border).groupBy("lang", "h").agg(F.min(F.substring("text", 1, DICTIONARY_BYTES)).alias("text"))
    parts: dict[str, list[bytes]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.h)):
        parts.setdefault(r.lang, []).append(letters(r.text))
    return {lang: b" ".join(p)[:DICTIONARY_BYTES] for lang, p in parts.items()}


class LanguageModel:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            # A dictionary needs eight bytes to be one.
            content = zstandard.ZstdCompressionDict(dictionaries[lang].ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of bytes saved against the second best); equal sizes go to the first name."""
        data = letters(text or "").strip()
        # Number signs and underscores are word characters, but no letters.
        if not data or not self.compressors or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for c, lang in zip(self.compressors, self.languages))
        return sizes[0][1], 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]


def language_of(dictionaries: dict[str, bytes], text: Column, min_margin: float = MIN_MARGIN) -> Column:
    """struct(lang_pred, score, accepted) of a text column."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])

    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = LanguageModel(dictionaries)
        for column in columns:
            found = [model.predict(x.as_py()) for x in column]
            yield pa.array([{"lang_pred": a, "score": s, "accepted": a != UNKNOWN and s >= min_margin} for a, s in found], type=kind)

    return predict(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_margin: float = MIN_MARGIN) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row, repeated ids included.

    Null or letterless texts are ``und`` with score 0 and not accepted, as is every
    text when nothing could be learned.
    """
    dictionaries = learn_dictionaries(docs, id_col, text_col, lang_col)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), language_of(dictionaries, F.col(text_col), min_margin).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is clear, as they are."""
    return docs.select(DOCUMENT_COLUMNS).where(language_of(learn_dictionaries(docs), F.col("text"))["accepted"])
