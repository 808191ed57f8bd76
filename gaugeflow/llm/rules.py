"""Quality rules: plain counts, and how far a document's histograms are from its language's.

Three histograms per document, over character classes, over all words (each of the
language's frequent words, and the others as one) and over the frequent words among
themselves, are compared with the sums of all documents of its language by
Jensen-Shannon distance. A language's frequent words are counted from all of its
documents. A text that is long enough is judged however few of them it has: their
absence is a distance too. JVM expressions only: one pass over the texts counts the
words, one leaves a narrow table of counts, everything after it works on that.
"""

from __future__ import annotations

from string import ascii_lowercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import materialise

SPACE = r"[\x20\x09-\x0D]+"
CLASSES = ("upper", "lower", "digit", "space", "mark", "symbol", "other")
N_COMMON = 25  # frequent words of a language
COMMON_LETTERS = 5  # words of more letters are not among them
MIN_CHARS = 200  # below, the character classes are not judged
MIN_WORDS = 50  # below, the words are not judged
MIN_COMMON = 30  # below, the frequent words are not judged among themselves
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.2  # of all words
WORD_NOISE = 1.0  # what chance adds to that distance in a text of one word; it falls with the root of their number
MAX_COMMON_DISTANCE = 0.7  # of the frequent words among themselves
PLACE_BITS = 24  # of a window's long; the rest is its hash
NARROWER = 8  # the rows of counts take that many times fewer partitions than texts do
LETTERS = "-" + ascii_lowercase[:N_COMMON]  # one for each frequent word, the first for any other


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _bound(x: Column, f) -> Column:
    """``f(x)`` with x worked out once and not wherever it is used."""
    return F.transform(F.array(x), f)[0]


def _covered(places: Column) -> Column:
    """Words in the three-word windows at the given places, in order."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(places, start, lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")), lambda a: a["n"])


def _compared(w: Column) -> Column:
    """The exact count by sorting the windows themselves; words hold no space, so a joined window stands for its words."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("text"), i.cast("long").alias("at")))

    def places(x: Column) -> Column:
        twice = F.filter(x, lambda v, i: F.coalesce(F.get(x, i - 1)["text"] == v["text"], F.lit(False)) | F.coalesce(F.get(x, i + 1)["text"] == v["text"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda v: v["at"]))

    return _covered(_bound(F.sort_array(windows), places))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found at least twice in the text.

    A window is one long: hash above, place below. Sorted, equal windows are
    neighbours; their places, sorted, give the covered words. Neighbours of equal
    hash are compared word by word, and a text in which two of them differ, or that
    has more words than places, is counted by its sorted windows instead, so the
    count is exact.
    """

    def count(w: Column) -> Column:
        low = (1 << PLACE_BITS) - 1

        def equal(a: Column, b: Column) -> Column:
            pair = F.struct(a.bitwiseAND(low).cast("int").alias("p"), b.bitwiseAND(low).cast("int").alias("q"))
            return F.when(F.shiftrightunsigned(a.bitwiseXOR(b), PLACE_BITS) == 0, pair)

        def covered(pairs: Column) -> Column:
            clash = F.exists(pairs, lambda x: ~((w[x["p"]] == w[x["q"]]) & (w[x["p"] + 1] == w[x["q"] + 1]) & (w[x["p"] + 2] == w[x["q"] + 2])))
            places = F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(x["p"].cast("long"), x["q"].cast("long"))))))
            return F.when(F.size(pairs) == 0, F.lit(0).cast("long")).when(clash, _compared(w)).otherwise(_covered(places))

        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.shiftleft(F.xxhash64(w[i], w[i + 1], w[i + 2]), PLACE_BITS).bitwiseOR(i.cast("long")))
        pairs = _bound(F.sort_array(windows), lambda c: F.array_compact(F.zip_with(c, F.slice(c, 2, F.size(c)), equal)))
        return F.when(F.size(w) > low, _compared(w)).otherwise(_bound(pairs, covered))

    return F.when(F.size(words) >= 4, _bound(words, count)).otherwise(F.lit(0).cast("long"))


def _letter_words(text: Column) -> Column:
    """Lower-cased runs of at most ``COMMON_LETTERS`` letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: (F.length(w) > 0) & (F.length(w) <= COMMON_LETTERS))


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")
    )


def frequent_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(word_lang, common): the most frequent short words of each language's texts, ties to the smaller word."""
    words = _rows(docs, id_col, text_col, lang_col).select("lang", F.explode(_letter_words(F.col("text"))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= N_COMMON)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return top.groupBy(F.col("lang").alias("word_lang")).agg(F.transform(ranked, lambda x: x["word"]).alias("common"))


def _common_counts(text: Column, common: Column) -> Column:
    """How often the text has each of the frequent words: they are written as one letter each, and letters are counted."""
    written = F.array_join(F.transform(_letter_words(text), lambda w: F.substring(F.lit(LETTERS), F.array_position(common, w).cast("int") + 1, F.lit(1))), "")
    one = F.lit(1)
    return _bound(written, lambda s: F.transform(F.sequence(F.lit(2), F.lit(N_COMMON + 1)), lambda i: (F.length(s) - F.length(F.replace(s, F.substring(F.lit(LETTERS), i, one), F.lit("")))).cast("long")))


def text_counts(docs: DataFrame, common: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One narrow row for every row of ``docs``; null text has no words, null language is one of its own."""
    text = F.col("text")
    rows = _rows(docs, id_col, text_col, lang_col).join(common, F.col("lang") == F.col("word_lang"), "left")
    rows = rows.withColumn("common", F.coalesce("common", F.array().cast("array<string>"))).withColumn("words", words_of(text))

    def of(pattern: str) -> Column:
        """Characters of a class; the rest is taken out in runs."""
        return F.length(F.regexp_replace(text, f"[^{pattern}]+", "")).cast("long")

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        of("#*$%&|<>").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.length("text").cast("long").alias("chars"),
        of(r"\p{Lu}").alias("upper"),
        of(r"\p{L}").alias("letters"),
        of(r"\p{Nd}").alias("digit"),
        of(r".,;:!?'\"()\-").alias("mark"),
        _common_counts(text, F.col("common")).alias("common"),
    )
    classes = [F.col("upper"), F.col("letters") - F.col("upper"), F.col("digit"), F.col("chars") - F.col("word_chars"), F.col("mark"), F.col("n_symbols")]
    rest = F.greatest(F.lit(0).cast("long"), F.col("word_chars") - F.col("letters") - F.col("digit") - F.col("mark") - F.col("n_symbols"))
    return rows.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.array(*classes, rest).alias("classes"), "common")


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if one is all zero."""

    def shares(x: Column) -> Column:
        return F.transform(F.array(_total(x).cast("double")), lambda n: F.transform(x, lambda v: v / F.nullif(n, F.lit(0.0))))[0]

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(shares(p), shares(q), lambda a, b: (term(a, b) + term(b, a)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.when((_total(p) > 0) & (_total(q) > 0), F.sqrt(F.greatest(F.lit(0.0), total)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every row.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    windows. ``kept``: not failed, and no judged histogram further from the
    language's than allowed. ``word_distance`` is of all words, ``common_distance``
    of the common ones among themselves. A document that repeats an id is judged on its own.
    """
    common = materialise(frequent_words(docs, id_col, text_col, lang_col), "frequent-words")
    counts = text_counts(docs, common, id_col, text_col, lang_col)
    # One exchange of narrow rows is read by both sides of the join below: the texts are gone over once.
    counts = counts.repartition(max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // NARROWER))
    others = F.greatest(F.lit(0).cast("long"), F.col("n_words") - _total(F.col("common")))
    counts = counts.withColumn("all_words", F.concat("common", F.array(others)))
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))] + [F.sum(F.col("all_words")[i]).alias(f"w{i}") for i in range(N_COMMON + 1)]
    # Spark reads an exchange twice only if both sides want the same columns of it.
    whole = F.max(F.xxhash64(*counts.columns)).alias("whole")
    reference = counts.groupBy("lang").agg(whole, *sums).where("whole IS NOT NULL")
    reference = reference.select(
        F.col("lang").alias("ref_lang"), F.array(*(f"c{i}" for i in range(len(CLASSES)))).alias("ref_classes"), F.array(*(f"w{i}" for i in range(N_COMMON + 1))).alias("ref_words")
    )
    # One row per language: Spark broadcasts it while it is small and splits a frequent language otherwise.
    both = counts.join(reference, F.col("lang") == F.col("ref_lang"))
    class_distance = F.when(_total(F.col("classes")) >= MIN_CHARS, js_distance(F.col("classes"), F.col("ref_classes")))
    word_distance = F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("all_words"), F.col("ref_words")))
    common_distance = F.when(_total(F.col("common")) >= MIN_COMMON, js_distance(F.col("common"), F.slice("ref_words", 1, N_COMMON)))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    both = both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), class_distance.alias("class_distance"), word_distance.alias("word_distance"), common_distance.alias("common_distance"))
    word_limit = F.lit(MAX_WORD_DISTANCE) + F.lit(WORD_NOISE) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    limits = {"class_distance": F.lit(MAX_CLASS_DISTANCE), "word_distance": word_limit, "common_distance": F.lit(MAX_COMMON_DISTANCE)}
    far = F.greatest(*(F.coalesce(c, F.lit(0.0)) > limit for c, limit in limits.items()))
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), *limits)
