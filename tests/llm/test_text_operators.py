"""The operators on training text against brute force, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from gaugeflow.llm import shingles as sh
from gaugeflow.llm import ann, bpe, jaccard, language, licenses, packing, pii, quality, queries, rules, token_files, tokens

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again in the morning light.", "en", "a", 80),
    (2, "the QUICK brown fox jumps over the lazy dog again and again in the morning light.", "en", "a", 80),
    (3, "The quick brown fox jumps over the lazy dog again and again in the morning light today.", "en", None, 80),
    (4, None, None, None, None),
    (5, "", "en", "a", 0),
    (6, " \t\n ", "de", "b", 4),
    (7, LONG, "en", "b", len(LONG)),
    (8, "one two", "en", "b", 7),
    (9, "one two", None, "b", 7),
    (10, "Write to a@b.c or +49 (30) 1234567, card 4111 1111 1111 1111, host 1.2.3.4, IBAN DE89 3704 0044 0532 0130 00.", "en", "b", 100),
    (None, "no id here", "en", "b", 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    # Names that the operators use inside.
    return plain.selectExpr("*", "1 as node", "'x' as word", "2 as words", "3 as rank", "4 as score", "5 as piece", "6 as kept", "7 as bucket", "8 as h").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    where: dict = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        for j in {j for s in sets[i] for j in where[s] if j > i}:
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_jaccard_groups_equal_brute_force(spark, docs, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(table).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in table.collect()])
    own = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert own == brute_groups([(r[0], r[1]) for r in ROWS if r[0] is not None])
    assert own[2][1] == 1 and own[9][1] == 8 and own[4] == (0, 4) and own[6] == (0, 6)


def test_jaccard_short_and_boundary_sets(spark):
    # Sets of 4 and 5 with 4 in common are just linked; 3 of 4 are not. Then chains and many near copies.
    base = [f"w{i}" for i in range(300)]
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "p q r s t u v"), (4, "p q r s t u v w"), (5, "p q r s t u v")]
    for k in range(60):
        words = list(base)
        words[(k * 37) % 300] = f"z{k}"
        words[(k * 11 + 5) % 300] = f"y{k}"
        rows.append((100 + k, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute_groups(rows)


@pytest.mark.parametrize("percent", [50, 95])
def test_jaccard_at_other_thresholds(spark, percent):
    random = np.random.Generator(np.random.PCG64(percent))
    rows, base = [], {}
    for i in range(120):
        n = int(random.integers(1, 40))
        words = base.setdefault(i % 12, [f"v{x}" for x in random.integers(0, 500, 40)])[:n]
        for at in random.integers(0, n, int(random.integers(0, 3))):
            words = [*words[:at], f"new{i}", *words[at + 1 :]]
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), percent).collect()}
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] < group[j]:
                    group[j], changed = group[i], True
    assert got == group


def test_links_of_copies_among_strangers_grow_with_their_number(spark):
    """Near copies and unrelated texts that all hold one passage: few links, all of them found."""
    random = np.random.Generator(np.random.PCG64(11))

    def prose(n):
        return [f"w{x}" for x in random.integers(0, 50_000, n)]

    passage = prose(60)
    for n in (120,):
        own, rows = prose(240), []
        for i in range(n):
            words = list(own)
            words[int(random.integers(0, 240))] = f"edit{i}"
            rows.append((i, " ".join([*words[:120], *passage, *words[120:]])))
        rows += [(n + i, " ".join([*prose(100), *passage, *prose(140)])) for i in range(5 * n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        groups = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
        assert all(groups[i] == (0 if i < n else i) for i in groups)
        bands = jaccard.size_bands()
        profile = jaccard.map_batches(docs, jaccard._profile, jaccard.PROFILE).withColumnRenamed("doc_id", "rep")
        assert jaccard.similar_pairs(docs, profile, bands).count() <= 2 * n


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)) + " " + "x" * 5000 + "  \n end of it all now"
    import pyarrow as pa

    whole = next(sh.shingle_sets(pa.array([text])))
    monkeypatch.setattr(sh, "PIECE", 997)
    assert np.array_equal(next(sh.shingle_sets(pa.array([text]))), whole)
    assert len(whole) == len(shingles(text))


def test_words_of_linked_sets_always_meet():
    random, bands = np.random.Generator(np.random.PCG64(3)), jaccard.size_bands()
    for n in (4, 5, 7, 9, 12, 20, 33, 60, 100, 200, 500):
        for _ in range(40):
            common = random.integers(0, 1 << 63, n, dtype=np.uint64)
            apart = n // 4
            a = np.unique(np.concatenate([common, random.integers(0, 1 << 63, apart // 2, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, random.integers(0, 1 << 63, apart - apart // 2, dtype=np.uint64)]))
            assert set(jaccard.block_words(a, bands)) & set(jaccard.block_words(b, bands))
            width = jaccard.sketch_width(min(len(a), len(b)))
            assert int(np.bitwise_count(jaccard.parity_bits(a, width) ^ jaccard.parity_bits(b, width)).sum()) <= apart
            wider = jaccard.parity_bits(a, 4 * width)
            assert np.array_equal(jaccard.folded(wider, width), jaccard.parity_bits(a, width))


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(queries.BYTE_VOCABULARY), tokens.TextEncoder(queries.BYTE_VOCABULARY)
    random = np.random.Generator(np.random.PCG64(1))
    texts = ["", " ", "\n", "  a", "a  b", "a \n b", "x\ny", "x\n\ny", "don't 's", "<|endoftext|> a", "a\r\nb ", "ü ñ 日本", "end. Next, one; two"]
    texts += ["".join(random.choice(list("ab 's\n\t1.é <|,"), 40)) for _ in range(500)]
    for t in texts * 2:
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_codec_equals_library():
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(queries.WORD_VOCABULARY), bpe.BytePairCodec(queries.WORD_VOCABULARY)
    random = np.random.Generator(np.random.PCG64(2))
    texts = ["", "  ", "It's I'LL don't", "<|endoftext|>Hi<|startoftext|>x", "é É ΣΑΣ İstanbul", "日本 😀", "a\x1cb \x1c c\x85d e", "a" * 60, "1234 ½", "é"]
    texts += ["".join(random.choice(list("aeiouthnrs'é É1!.ΣΩ日\n<|"), 60)) for _ in range(400)] + ["".join(random.choice(list("abnthei"), 40)) for _ in range(400)]
    for t in texts:
        ids = whole.encode(t, add_special_tokens=False).ids
        got = np.frombuffer(ours.encode(t), "<u4")
        assert got.tolist() == ids
        assert ours.decode(got) == whole.decode(ids, skip_special_tokens=False)


def test_round_trip_digest(docs, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.WORD_VOCABULARY)
    got = {r.doc_id: r for r in bpe.round_trip_digest(docs, queries.WORD_VOCABULARY).collect()}
    for i, text, *_ in ROWS:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip_digest(empty, queries.WORD_VOCABULARY).count() == 0
    encoded = bpe.encode_documents(docs, queries.WORD_VOCABULARY)
    back = {r.doc_id: r.text for r in bpe.decode_documents(encoded, queries.WORD_VOCABULARY).collect()}
    assert back[8] == "one</w> two</w>" and back[4] == ""


@pytest.mark.parametrize("n", [1, 2, 127, 1024])
def test_blocks_round_trip(n):
    random = np.random.Generator(np.random.PCG64(n))
    for ids in (random.integers(0, 1 << 32, n), random.integers(7, 9, n), np.full(n, 5), np.where(random.random(n) < 0.05, (1 << 32) - 1, random.integers(0, 300, n))):
        for percentile in (0, 50, 90, 100):
            assert (token_files.read_block(token_files.write_block(ids.astype(np.uint32), percentile)) == ids).all()


def test_token_files(docs, empty, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "FILE_IDS", 1000)
    whole, at = Tokenizer.from_file(queries.BYTE_VOCABULARY), 0
    got = {r.doc_id: r for r in token_files.token_files_digest(docs, queries.BYTE_VOCABULARY).collect()}
    for i, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_files.token_files_digest(empty, queries.BYTE_VOCABULARY).count() == 0
    file = token_files.TokenFile(token_files.encode_file([3, None], [np.arange(3000, dtype="<u4").tobytes(), b""]))
    assert file.doc_ids == [3, None] and (file.ids(1000, 2100) == np.arange(1000, 2100)).all()
    with pytest.raises(ValueError):
        token_files.TokenFile(b"x" * 100)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    rows = packing.best_fit_packing(docs, queries.BYTE_VOCABULARY).collect()
    for i, text, *_ in ROWS:
        ids, own = [*whole.encode(text or "", add_special_tokens=False).ids, 2], sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 1024)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.best_fit_packing(empty, queries.BYTE_VOCABULARY).count() == 0


def test_packing_writes_no_file_for_each_input_partition(spark, monkeypatch):
    """Every file costs an executor a child process; 60 small partitions used to make 60 files of pieces."""
    written = {}

    def keep(df, name):
        written[name] = packing_materialise(df, name)
        return written[name]

    packing_materialise = packing.materialise
    monkeypatch.setattr(packing, "materialise", keep)
    docs = spark.range(0, 600, numPartitions=60).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), 1 + id % 40) AS text")
    rows = packing.best_fit_packing(docs, queries.BYTE_VOCABULARY).collect()
    assert {r.doc_id for r in rows} == set(range(600))
    assert len(written["pieces"].inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_packing_plan_is_tight():
    random = np.random.Generator(np.random.PCG64(5))
    counts = np.bincount(random.integers(1, 1025, 20_000), minlength=1025)
    plan = packing.plan(counts)
    used = np.zeros(1025, np.int64)
    for items, times in plan:
        assert sum(items) <= 1024
        np.add.at(used, list(items), times)
    assert (used == counts).all()
    assert sum(t for _, t in plan) <= 1.01 * -(-(counts @ np.arange(1025)) // 1024)
    assert packing.plan(np.array([0, 0, 3, 0, 0])) == [((2, 2), 1), ((2,), 1)]


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(d[::-1])) % 10 == 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def test_personal_data(spark, docs, empty, sf_dir):
    odd = ["a@b.c_d@e.f x@y.z@q.w", "a@b.c-x_y@d.e..f", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1112 12 3", "+1 (234) 555-6789. +12 +1234567890123456", "üñ 😀 +49 (30) 1234567 é 1.1.1.1", "12  34-5 6 - 7", "1 4111111111111111", "5500005555555559 4111111111111111-"]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(docs.select("doc_id", "text")).union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts, n = {}, 0
    for r in table.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for r in pii.personal_data_digest(table).collect():
        hashes = {hashlib.sha256(",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, t) if ok(m.group())).encode()).hexdigest() for t in texts[r.doc_id]}
        assert r.base_sha256 in hashes
        n += 1
    assert n == table.count()
    ten = next(r for r in pii.personal_data_digest(docs).collect() if r.doc_id == 10)
    assert (ten.n_email, ten.n_ip, ten.n_card, ten.n_phone, ten.n_iban) == (1, 1, 1, 1, 1)
    stage = {r.doc_id: r.text for r in pii.without_personal_data(docs).collect()}
    assert stage[10] == "Write to [EMAIL] or [PHONE], card [CARD], host [IP], IBAN [IBAN]." and stage[4] is None and stage[8] == "one two"
    assert pii.personal_data_digest(empty).count() == 0
    scores = pii.find_personal_data(docs).where("doc_id = 10").first()
    assert scores.card[0].score > pii.RULES["card"].score and scores.phone[0].score == pii.RULES["phone"].score


def test_scores_decide_on_added_kinds(spark):
    """Context words raise a score across earlier matches, and an IBAN of an unknown country needs them."""
    check = 98 - int("".join(str(int(c, 36)) for c in "12345678901234XX00")) % 97
    odd = f"XX{check:02d} 1234 5678 9012 34"
    texts = [f"see {odd} .", f"my account {odd} .", "DE89 3704 0044 0532 0130 00", "mail to a@b.cd , c@d.ef", f"account {odd} , {odd} end"]
    got = {r.doc_id: r for r in pii.personal_data_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_iban for i in range(5)] == [0, 1, 1, 0, 2]
    assert [got[i].n_any for i in range(5)] == [0, 1, 1, 2, 2]
    assert [got[i].scores for i in range(4)] == ["", "0.8", "0.8", "0.95,0.95"]


def test_ibans_before_other_words(spark):
    spanish = "ES91 2100 0418 4502 0005 1332"
    cases = [
        ("BE68 5390 0754 7034 BIC", ["BE68 5390 0754 7034"]),
        ("BE68539007547034 IN Euro", ["BE68539007547034"]),
        (f"x {spanish} 2024 y", [spanish]),
        (f"{spanish} {spanish}", [spanish, spanish]),
        ("DE12 BE68 5390 0754 7034 AB12 CD", ["BE68 5390 0754 7034"]),
        ("DE89 3704 0044 0532 0130 00.", ["DE89 3704 0044 0532 0130 00"]),
        ("BE68 5390 0754 7035 BIC, BE68 5390 0754 7034x, aBE68 5390 0754 7034", []),
    ]
    rows = pii.find_personal_data(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    for r in rows:
        assert [s.value for s in r.iban] == cases[r.doc_id][1] == [r.text[s.start : s.end] for s in r.iban], r.text


def test_quality_rules(spark, docs, empty):
    odd = ["a b c a b c", "a a a a", "x\ny\nx\n \n \nx", "ü#*$ ü#*$ ü#*$ ü#*$", "a b a b a b", "A#" * 400 + " x" * 60]
    table = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(100 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in rules.judge(table).collect()}
    for i, text in [(r[0], r[1]) for r in ROWS] + list(enumerate(odd, 100)):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seen: dict = {}
        for k in range(len(w) - 2):
            seen.setdefault(tuple(w[k : k + 3]), []).append(k)
        covered = {k + d for ks in seen.values() if len(ks) > 1 for k in ks for d in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want = (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.kept and r.base_failed)
    assert rules.judge(empty).count() == 0


def test_quality_rules_judge_texts_without_common_words(spark):
    usual = [(i, " ".join(f"the tree{i}x{j} of house{j} and" for j in range(60)), "en") for i in range(20)]
    rows = usual + [(100, " ".join(f"quarrel{j}zephyr" for j in range(400)), "en"), (101, " ".join(f"quarrel{j}zephyr" for j in range(20)), "en")]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i, _, _ in usual), got[0]
    assert got[100].common_distance is None and got[100].word_distance > rules.MAX_WORD_DISTANCE and not got[100].base_failed and not got[100].kept
    assert got[101].word_distance is None


def plain_verdicts(rows):
    """Distances and verdicts by plain Python: (class, word, common distance, kept) of each row."""
    import math
    import unicodedata
    from collections import Counter

    def distance(p, q):
        if not sum(p) or not sum(q):
            return None
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        return math.sqrt(max(0.0, sum(a * math.log2(2 * a / (a + b)) for x, y in zip(p, q) for a, b in ((x, y), (y, x)) if a > 0) / 2))

    def tokens(t):
        return [w for w in re.split(r"[\W\d_]+", t.lower()) if 0 < len(w) <= rules.COMMON_LETTERS]

    texts = [(lang or "", t or "") for _, t, lang in rows]
    frequent = {}
    for lang in {x for x, _ in texts}:
        n = Counter(w for x, t in texts if x == lang for w in tokens(t))
        frequent[lang] = [w for w, _ in sorted(n.items(), key=lambda x: (-x[1], x[0].encode()))[: rules.N_COMMON]]
    counts = []
    for lang, t in texts:
        kinds = Counter("upper" if (c := unicodedata.category(x)) == "Lu" else "lower" if c[0] == "L" else "digit" if c == "Nd" else "" for x in t)
        space = len(re.findall(r"[\x20\x09-\x0D]", t))
        mark, symbol = (sum(map(t.count, chars)) for chars in (".,;:!?'\"()-", "#*$%&|<>"))
        classes = [kinds["upper"], kinds["lower"], kinds["digit"], space, mark, symbol]
        seen = Counter(tokens(t))
        common = [seen[w] for w in frequent[lang]]
        common += [0] * (rules.N_COMMON - len(common))
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        counts.append((lang, [*classes, max(0, len(t) - sum(classes))], [*common, max(0, len(words) - sum(common))], len(words), len(covered)))
    sums = {}
    for lang, classes, words, *_ in counts:
        a, b = sums.setdefault(lang, ([0] * 7, [0] * (rules.N_COMMON + 1)))
        sums[lang] = ([x + y for x, y in zip(a, classes)], [x + y for x, y in zip(b, words)])
    out = []
    for lang, classes, words, n, covered in counts:
        a, b = sums[lang]
        c = distance(classes, a) if sum(classes) >= rules.MIN_CHARS else None
        w = distance(words, b) if n >= rules.MIN_WORDS else None
        m = distance(words[:-1], b[:-1]) if sum(words[:-1]) >= rules.MIN_COMMON else None
        limits = ((c, rules.MAX_CLASS_DISTANCE), (w, rules.MAX_WORD_DISTANCE + rules.WORD_NOISE / math.sqrt(max(n, 1))), (m, rules.MAX_COMMON_DISTANCE))
        out.append((c, w, m, n >= 50 and 100 * covered <= 50 * n and not any(x is not None and x > limit for x, limit in limits)))
    return out


def test_verdicts_equal_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(1 << 40, "²½Ⅷ ａｂ ÀÉ٣ 1_2 \x85\u00a0x\n" * 80, "xx"), ((1 << 40) + 1, "mot mot autre " * 30, None)]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    for (i, _, _), want in zip(rows, plain_verdicts(rows)):
        r = got[i]
        assert r.kept == want[3]
        for mine, plain in zip((r.class_distance, r.word_distance, r.common_distance), want):
            assert (mine is None) == (plain is None) and (plain is None or abs(mine - plain) < 1e-9)


def test_windows_compared_as_texts(spark):
    from pyspark.sql import functions as F

    random = np.random.Generator(np.random.PCG64(8))
    rows = [(i, [str(x) for x in random.integers(0, int(random.integers(1, 6)), int(random.integers(4, 40)))]) for i in range(200)]
    table = spark.createDataFrame(rows, "i long, w array<string>")
    for r in table.select("w", rules.repeated_words(F.col("w")).alias("fast"), rules._compared(F.col("w")).alias("sorted")).collect():
        windows = [tuple(r.w[k : k + 3]) for k in range(len(r.w) - 2)]
        assert r.fast == r.sorted == len({k + d for k, x in enumerate(windows) if windows.count(x) > 1 for d in range(3)})


def test_licences(spark, empty):
    rows = [
        (1, "/a/LICENSE", "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"),
        (2, "/a/b/c/x.txt", "plain words"),
        (3, "/a/b/y.txt", "Licensed under the Apache License, Version 2.0.\nmore\nlast"),
        (4, "/a/b/c/d/z.txt", None),
        (5, "/q/w.txt", "nothing"),
        (6, None, "Released under the MIT License."),
        (7, "/a/n.txt", "one\nsome licensed fish\ntwo"),
        (7, "/a/n.txt", "one\nsome licensed fish\ntwo"),
    ]
    got = sorted(((r.doc_id, r.own_licence, r.licence, r.found_in) for r in licenses.scan_licences(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()), key=str)
    assert got == [
        (1, "MIT", "MIT", None),
        (2, None, "Apache-2.0", "/a/b"),
        (3, "Apache-2.0", "Apache-2.0", None),
        (4, None, "Apache-2.0", "/a/b"),
        (5, None, None, None),
        (6, "MIT", "MIT", None),
        (7, None, "MIT", "/a"),
        (7, None, "MIT", "/a"),
    ]
    assert licenses.scan_licences(licenses.document_paths(empty)).count() == 0


def test_language(spark, docs, empty, sf_dir):
    table = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    truth = {r.doc_id: r.lang for r in table.collect()}
    rows = language.identify(table).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert sum(r.accepted for r in rows) >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(odd) == len(ROWS) and odd[4].lang_pred == odd[5].lang_pred == odd[6].lang_pred == "und" and odd[1].lang_pred in ("en", "de")
    assert language.identify(empty).count() == 0


def test_language_needs_a_letter_and_equals_a_plain_loop(spark, sf_dir):
    """Number signs are no letters; predictions by compressing with each dictionary in turn."""
    import zstandard

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    books = language.learn_dictionaries(table)
    odd = ["²", "½ Ⅷ", "①② 12_3", "ª", "ⅷ a", "日本語"]
    rows = [tuple(r) for r in table.select("doc_id", "text").orderBy("doc_id").limit(60).collect()] + [(10**6 + i, t) for i, t in enumerate(odd)]
    found = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", language.language_of(books, language.F.col("text")).alias("p")).collect()
    got = {r.doc_id: (r.p.lang_pred, r.p.score) for r in found}
    for i, text in rows:
        data = re.sub(r"[\W\d_]+", " ", (text or "").lower()).encode().strip()
        if not any(c.isalpha() for c in text or ""):
            assert got[i] == ("und", 0.0)
            continue
        sizes = []
        for lang, book in sorted(books.items()):
            total = 0
            for k in range(0, len(data), language.PIECE_BYTES):
                content = zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                total += len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=content, write_content_size=False).compress(data[k : k + language.PIECE_BYTES]))
            sizes.append((total, lang))
        (best, lang), (second, _) = sorted(sizes)[:2]
        assert got[i] == (lang, pytest.approx(1 - best / second))


def test_language_of_long_texts(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/documents.parquet")
    texts = [r.text for r in table.where("lang = 'en' and text is not null and doc_id < 6000").orderBy("doc_id").collect()]
    model = language.LanguageModel(language.learn_dictionaries(table))
    long = "\n".join(texts)
    assert len(long) > 3_000_000
    found = [model.predict(long[:n]) for n in (100_000, 1_000_000, len(long))]
    assert all(lang == "en" and score > 5 * language.MIN_MARGIN for lang, score in found), found


def test_quality_classifier(spark, docs, empty, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    table = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 3000")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in quality.classify(table).collect() if r.doc_id in labels]
    good = [r.kept for r in got if labels[r.doc_id] == 1]
    bad = [r.kept for r in got if labels[r.doc_id] == 0]
    assert sum(good) >= 0.985 * len(good) and sum(bad) <= 0.1 * len(bad)
    odd = {r.doc_id: r for r in quality.classify(docs).collect()}
    assert len(odd) == len(ROWS) and odd[4].score == odd[5].score == odd[6].score == 0.0
    assert quality.classify(empty).count() == 0


def test_neighbours(spark):
    random = np.random.Generator(np.random.PCG64(9))
    vectors = random.standard_normal((3000, 16)).astype(np.float32)
    vectors[200:900] = vectors[200]  # a very common vector
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] + [1.0] * 15), (3060, [None] + [1.0] * 15), (3080, []), (None, [1.0] * 16), (3100, [1.0, 2.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as dim", "2 as block")).collect()
    x, got = vectors.astype(np.float64), {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for q, mine in got.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        mine.sort()
        assert [r for r, _, _ in mine] == list(range(1, 21)) and all(abs(s - scores[v]) < 1e-9 for _, v, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len({v for _, v, _ in mine} & set(np.lexsort((np.arange(3000), -scores))[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in ann.nearest_neighbours(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest_neighbours(few.where("false")).count() == 0


def test_copies_of_a_vector_tie():
    """Equal vectors get equal scores wherever they stand, and come by id."""
    random = np.random.Generator(np.random.PCG64(21))
    vectors = random.standard_normal((2000, 64))
    copies = np.sort(random.choice(2000, 60, replace=False))
    vectors[copies] = vectors[copies[0]]
    ids = np.arange(2000)
    ranges = ann.norm_ranges(vectors, ids)
    near = vectors[copies[0]] + 0.05 * random.standard_normal((40, 64))
    q, v, s = ann.nearest_in(ranges, near, np.arange(10_000, 10_040), 20)
    for query in range(10_000, 10_040):
        mine = [(-score, i) for score, i in zip(s[q == query], v[q == query])]
        assert mine == sorted(mine)
        assert len({score for score, i in mine if i in set(copies.tolist())}) <= 1


@pytest.mark.parametrize("sigma, longest", [(0.0, 1.0), (0.0, 10.0), (0.5, 1.0)])
def test_neighbours_of_uneven_norms(sigma, longest):
    random = np.random.Generator(np.random.PCG64(4))
    x = random.standard_normal((8000, 64))
    x *= (np.exp(sigma * random.standard_normal(len(x))) / np.linalg.norm(x, axis=1))[:, None]
    x[1] *= longest
    ids = np.arange(len(x)) * 3
    asked = np.arange(0, len(x), 200)
    q, v, s = ann.nearest_in(ann.norm_ranges(x, ids), x[asked], ids[asked], 20)
    hits = 0
    for a in asked:
        scores = x @ x[a]
        scores[a] = -np.inf
        hits += len(set(v[q == ids[a]]) & set(ids[np.argsort(-scores)[:20]]))
    assert len(q) == 20 * len(asked) and hits >= 0.9 * 20 * len(asked)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert 0 < docs.count() <= before
        before = docs.count()
        if name == "jaccard_join":
            groups = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
            assert all(i == g for i, (_, g) in groups.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == len(packed)


def test_queries_with_sql(spark, sf_dir):
    from check_oracles import compare, database

    con = database(sf_dir)
    for name, sql in queries.ORACLES.items():
        assert compare(spark, con, sf_dir, name, queries.QUERIES[name], sql)[0].startswith("ok")
