"""Personal data in text: patterns propose spans, checksums confirm, context words adjust the score.

Everything is a JVM expression over one row; there is no shuffle. Positions come
from splitting the text at the matches: what stands between two matches and the
matches themselves have known lengths. An IBAN's match is only its first four
characters; the rest is looked at ahead and may hold the start of another one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import DOCUMENT_COLUMNS

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
CONTEXT = 40  # characters before a span that are searched for context words
MIN_SCORE = 0.7  # of a span of an added kind; base kinds always stay
UNKNOWN_COUNTRY = 0.6  # score of an IBAN whose country's length is not known: context words must speak for it


@dataclass(frozen=True)
class Rule:
    """A pattern, its certainty when confirmed, and the words that raise it.

    The look-arounds and possessive repeats of the base kinds only save time: a
    match of the plain pattern can start nowhere else, and never gives characters
    back. ``needs`` is a cheap test that every text with a match passes. The span is
    the group of this number.
    """

    pattern: str
    needs: str
    score: float
    words: str
    group: int = 0


# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """A country's code, then as many characters as its IBANs have; of other countries, as long as it goes."""

    def rest(n: int) -> str:
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")

    known = "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}{rest(n)}" for n, codes in IBAN_LENGTHS.items())
    codes = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = rf"(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{known}|{other})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"


RULES = {
    # The character before the start is no local one, unless the last match ended right here.
    "email": Rule(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|kontakt|correo|courriel"),
    "ip": Rule(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, r"\bip\b|address|host|server|adresse|dirección"),
    # A whole run of digits with single spaces or hyphens inside, 13 to 19 digits long.
    "card": Rule(r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", "", 0.7, "card|visa|credit|karte|carte|tarjeta"),
    "phone": Rule(r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "phone|call|tel|mobile|telefon|téléphone|teléfono"),
    "iban": Rule(_iban_pattern(), "", 0.8, "iban|konto|account|compte|cuenta", 1),
}

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def luhn(number: Column) -> Column:
    """Whether the digits of ``number`` have a Luhn check digit; other characters are ignored."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), ""), lambda d: d.cast("int"))
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an IBAN's check digits are right; blanks are ignored."""
    plain = F.regexp_replace(number, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    # Letters are two digits.
    return F.aggregate(value, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


def confirmed(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return _digits(match).between(13, 19) & luhn(match)
    if kind == "phone":
        return _digits(match).between(9, 15)
    return F.length(F.regexp_replace(match, "[^A-Z0-9]", "")).between(15, 34) & mod97(match)


def spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of a kind: array of (kind, start, end, value, score), in code points, end exclusive.

    Spans of kinds beyond the base ones also need a score of ``MIN_SCORE``.
    """
    rule = RULES[kind]
    between = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    both = F.transform(found, lambda m: F.struct(m.alias("match"), m.alias("value")))
    if rule.group:
        both = F.zip_with(found, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m, v: F.struct(m.alias("match"), v.alias("value")))
    # Each match with what stands before it, then a running position.
    steps = F.zip_with(F.slice(between, 1, F.size(found)), both, lambda before, b: F.struct(before.alias("before"), b["match"].alias("match"), b["value"].alias("value")))
    span = "struct<kind:string,start:int,end:int,value:string,score:double>"

    certain = F.lit(rule.score)
    if kind == "iban":
        countries = [c for codes in IBAN_LENGTHS.values() for c in codes.split()]

    def add(acc: Column, step: Column) -> Column:
        start, value = acc["at"] + F.length(step["before"]), step["value"]
        own = F.when(F.left(value, F.lit(2)).isin(*countries), certain).otherwise(F.lit(UNKNOWN_COUNTRY)) if kind == "iban" else certain
        # What stands before a span, earlier matches included.
        before = F.right(F.concat(acc["tail"], step["before"]), F.lit(CONTEXT))
        score = own + F.when(F.lower(before).rlike(rule.words), (F.lit(1.0) - own) / 2).otherwise(F.lit(0.0))
        made = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), score.alias("score"))
        good = confirmed(kind, value) if kind in BASE_KINDS else confirmed(kind, value) & (score >= MIN_SCORE)
        kept = F.when(good, F.concat(acc["spans"], F.array(made))).otherwise(acc["spans"])
        tail = F.right(F.concat(before, step["match"]), F.lit(CONTEXT))
        return F.struct((start + F.length(step["match"])).alias("at"), tail.alias("tail"), kept.alias("spans"))

    empty = F.expr(f"cast(array() as array<{span}>)")
    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), empty.alias("spans")), add, lambda acc: acc["spans"])
    # Without a first hint of the kind the text is neither split nor searched.
    hint = F.contains(text, F.lit(rule.needs)) if rule.needs else text.rlike("[0-9]{2}" if kind == "iban" else "[0-9][\\x20-]?[0-9]")
    return F.when(hint, walked).otherwise(empty)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, one array of spans for each kind) of every row.

    Null text is empty and has no spans. Rows that repeat an id or have none are
    rows like others; columns of other names are left out, so none can clash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", *(spans_of(k, F.col("text")).alias(k) for k in KINDS))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts, the base spans' hash, all spans with their scores in the same order, and how many there are, of every document."""
    found = find_personal_data(docs)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.sha2(listed(F.concat(*BASE_KINDS)), 256)
    scores = F.array_join(F.transform(F.concat(*KINDS), lambda s: F.round(s["score"], 2).cast("string")), ",")
    return found.select("doc_id", *counts[:4], base.alias("base_sha256"), listed(F.concat(*KINDS)).alias("spans"), counts[4], scores.alias("scores"), F.size(F.concat(*KINDS)).cast("long").alias("n_any"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first names the place."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def put(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(fresh, piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def without_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with personal data redacted; ``n_chars`` counts the new text. Null texts stay null."""
    text = F.col("text")
    new = docs.select("doc_id", redacted(text, F.concat(*(spans_of(k, F.coalesce(text, F.lit(""))) for k in KINDS))).alias("text"), "lang", "source", "n_chars")
    return new.select("doc_id", "text", "lang", "source", F.coalesce(F.length("text").cast("long"), "n_chars").alias("n_chars")).select(DOCUMENT_COLUMNS)
