"""Repair and formatting of conversations, and the audit of filters, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations, product

import numpy as np
import pytest

from gaugeflow.llm import audit, chat, queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
LONG = "A long turn. " * 40_000
ROWS = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "What is it?"),
    (1, 2, "assistant", "It is that."),
    (2, 0, "system", "Be brief."),
    (2, 1, "user", "What is it?"),
    (2, 2, "assistant", "No idea"),
    (2, 3, "assistant", "No idea"),
    (2, 7, "tool", " \t\n"),
    (3, 0, "system", "Be brief."),
    (3, 1, "user", "What is it?"),
    (4, None, None, None),
    (4, None, "user", "early."),
    (4, 5, "assistant", None),
    (5, 0, "user", LONG),
    (5, 1, "assistant", LONG + "cut"),
    (5, 2, "", ""),
    (None, 0, "user", "Without an id?"),
    (None, 1, "assistant", "Yes <s> \\[INST] <\\s> <|endoftext|> </s"),
    (7, 0, "assistant", "[/INST"),
    (7, 0, "assistant", "[/INST"),
    (8, 3, "ro<s>le\n\\", "  !"),
    (9, 0, "system", "Be brief."),
    (9, 1, "user", "What is it?"),
    (9, 2, "assistant", "It is that."),
    *[(10, i, "user" if i % 2 else "assistant", f"Turn {i}" + "." * (i % 5 > 0)) for i in range(60)],
]


@pytest.fixture(scope="module")
def talks(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.selectExpr("*", "1 as place", "2 as node", "'x' as fault", "3 as digest", "4 as present", "5 as start", "6 as rank", "7 as path").repartition(5)


def rows_of(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


def by_conversation(rows, role=" ", text=" "):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c].append((t, role if r is None else r, text if x is None else x))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def plain_damage(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        out[c] += [row] * {0: 0, 3: 2}.get(kind, 1)
    return {c: by_conversation(v).get(c, []) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Shortest edits by a plain table over (rows taken, what the output is): nothing, s, pairs, open pair."""
    follow = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 3, (3, "a"): 2, (2, "u"): 3}
    table = {0: (0, "")}
    def inserted(table):
        for _ in range(4):
            for (state, role), to in follow.items():
                if state in table and role != "s":
                    cost, edits = table[state]
                    table[to] = min(table.get(to, (1 << 40, "")), (cost + 3, edits + "I"))
        return table
    table = inserted(table)
    for (_, role, _), fault in zip(rows, found):
        new = {}
        for state, (cost, edits) in table.items():
            options = [(state, cost + 4, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                options += [(to, cost + extra + (0 if r == role[:1] else 3), "K" if r == role[:1] else "R") for (s, r), to in follow.items() if s == state and (r == role[:1] or r != "s")]
            for to, c, e in options:
                new[to] = min(new.get(to, (1 << 40, "")), (c, edits + e))
        table = inserted(new)
    return min(table[s] for s in (0, 2) if s in table)


def apply_edits(rows, edits):
    out, rows, expects = [], iter(rows), "u"
    for e in edits:
        role, text = {"u": "user", "a": "assistant"}[expects], ""
        if e != "I":
            _, own, text = next(rows)
            if e == "D":
                continue
            role = own if e == "K" else role
        if not (e == "K" and role[:1] == "s"):
            expects = "a" if expects == "u" else "u"
        out.append((role, text))
    return out


def plain_repair(rows):
    out = {}
    for c, conv in plain_damage(rows).items():
        found = faults(conv)
        turns = [t for t, _, _ in conv if t is not None]
        initials = [r[:1] for _, r, _ in conv]
        cost, edits = cheapest(conv, found)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        text = "\n".join(f"{r}:{x}" for r, x in apply_edits(conv, edits))
        n = Counter(found)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_repair_equals_plain_python(spark, talks, sf_dir):
    for df, rows in ((talks, ROWS), (spark.read.parquet(f"{sf_dir}/conversations.parquet"), rows_of(spark, sf_dir))):
        got = [tuple(r) for r in repair.repair_digest(df).collect()]
        assert len(got) == len({r[0] for r in rows})
        assert {r[0]: r[1:] for r in got} == plain_repair(rows)


def test_repair_is_the_cheapest_of_all_edits():
    """Every string of edits with up to two insertions between rows, on short conversations."""
    random.seed(5)
    accepted = re.compile("(s?(ua)+)?")

    def cost_of(conv, found, edits):
        """Cost of the edits, or None if they cannot give an accepted conversation."""
        cost, rows, roles = 0, iter(zip(conv, found)), ""
        for e in edits:
            if e == "I":
                cost, roles = cost + 3, roles + "?"
                continue
            (_, role, _), fault = next(rows)
            if e == "D":
                cost += 4
            elif fault in ("blank", "duplicate"):
                return None
            else:
                cost += 3 * (e == "R") + 3 * (fault == "truncated")
                roles += role[:1] if e == "K" else "?"
        for start in ("", "s"):
            want = start + "ua" * ((len(roles) - len(start)) // 2)
            if len(want) == len(roles) and accepted.fullmatch(want) and all(r == w or r == "?" and w != "s" for r, w in zip(roles, want)):
                return cost
        return None

    for _ in range(60):
        n = random.randrange(4)
        conv = [(i, random.choice(["system", "user", "assistant", "tool"]), random.choice([f"{i}.", f"{i}", "same.", ""])) for i in range(n)]
        found = faults(conv)
        gaps = list(product(["", "I", "II"], repeat=n + 1))
        every = ("".join(g + e for g, e in zip(gap, [*edits, ""])) for gap in gaps for edits in product("KRD", repeat=n))
        best = min((c, e) for e in every if (c := cost_of(conv, found, e)) is not None)
        parser = repair.Parser()
        for (_, role, _), fault in zip(conv, found):
            parser.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        top = parser.best()
        assert (top.cost, top.audit) == best == cheapest(conv, found)


def test_parser_keeps_the_undecided_only():
    random.seed(3)
    parser, waiting = repair.Parser(), 0
    for _ in range(20_000):
        parser.row(random.choice("uuaat"), random.random() < 0.05, random.random() < 0.1)
        parser.decided()
        waiting = max(waiting, max(len(t.audit) for t in parser.tops.values()))
    assert waiting < 200


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_digest(empty).count() == 0
    assert chat.chat_digest(empty, queries.BYTE_VOCABULARY).count() == 1


def test_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (1, 2, "user", "Well?")], SCHEMA).selectExpr("*", "true as present")
    got = repair.repaired_turns(rows).collect()
    assert [(r.place, r.edit, r.role, r.text) for r in got[:-1]] == [(0, "K", "user", "Hi."), (1, "R", "assistant", "Well?")]
    assert (got[-1].place, got[-1].duplicate, got[-1].cost, got[-1].audit) == (None, 1, 7, "KRD")


def test_escapes():
    random.seed(1)
    for _ in range(20_000):
        text = "".join(random.choice([*chat.RESERVED, "\\", "<", "[", "s>", "/", "INST]", "</", "a", "|"]) for _ in range(random.randrange(9)))
        out = chat.escaped(text)
        assert chat.unescaped(out) == text and not any(s in out for s in chat.RESERVED)


def plain_chat(rows):
    out = {}
    for c, conv in by_conversation([*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "", "").items():
        turns = "".join(f"{r}\n{x}\n" for _, r, x in conv)
        loss = "".join(x for _, r, x in conv if r == "assistant")
        formatted = "".join(f"<s>{chat.escaped(x)}</s>" if r == "assistant" else f"[INST]{chat.escaped(r)}<s>{chat.escaped(x)}[/INST]" for _, r, x in conv)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (turns, loss)]
        out[c] = (len(conv), digest[0], len(loss), digest[1], len(formatted))
    return out


def test_chat_equals_plain_python(spark, talks):
    got = [tuple(r) for r in chat.chat_digest(talks, queries.BYTE_VOCABULARY).collect()]
    assert {r[0]: r[1:] for r in got} == plain_chat(ROWS) and len(got) == len(plain_chat(ROWS))


def test_chat_tree_shares_and_attends(spark, talks):
    segments, members = chat.chat_tree(talks, queries.BYTE_VOCABULARY)
    codec = chat.codec(queries.BYTE_VOCABULARY)
    rows = sorted(segments.collect(), key=lambda r: r.start)
    tokens = [np.frombuffer(r.tokens, "<u4") for r in rows]
    stream = np.concatenate(tokens)
    # Gapless, and every shared beginning once.
    assert [r.start for r in rows] == [0, *np.cumsum([len(t) for t in tokens])[:-1].tolist()]
    paths = {tuple((r, x) for _, r, x in conv[: i + 1]) for conv in by_conversation(ROWS, "", "").values() for i in range(len(conv))}
    assert len(rows) == len(paths)
    of = {r.start: r for r in rows}
    spoken = defaultdict(dict)
    for m in members.collect():
        spoken[m.conv_id][m.place] = of[m.start]
    for c, conv in by_conversation(ROWS, "", "").items():
        ids = [np.frombuffer(spoken[c][i].tokens, "<u4") for i in range(len(conv))]
        assert [chat.spoken(codec.turn(x)) for x in ids] == [(r, x) for _, r, x in conv]
        # The last segment attends to exactly the conversation, and positions count its tokens.
        last = spoken[c][len(conv) - 1]
        assert np.array_equal(np.concatenate([stream[a["from"] : a["to"]] for a in last.attends]), np.concatenate(ids))
        assert [spoken[c][i].position for i in range(len(conv))] == [0, *np.cumsum([len(x) for x in ids])[:-1].tolist()]
        assert all(a["to"] < b["from"] for a, b in zip(last.attends, last.attends[1:]))
    # Depth first: children of a node lie inside one run of the stream.
    for r in rows:
        inside = [s.start for s in rows if any(a["from"] <= r.start < a["to"] for a in s.attends)]
        between = [s.start for s in rows if min(inside) <= s.start <= max(inside)]
        assert inside == between


DOCS = [
    (1, "the a " * 150, "en"),
    (2, "the a " * 150, "de"),
    (3, "the a " * 150, None),
    (4, None, "en"),
    (5, "", ""),
    (6, " ".join(f"w{i}" for i in range(250)), "en"),
    (7, " ".join(f"W{i}&" for i in range(250)), "en"),
    (7, " ".join(f"W{i}&" for i in range(250)), "en"),
    (8, " ".join(f"w{i}" for i in range(250)) + " x\x85y\x1cz", "fr"),
    (9, "word " * 200_000, "fr"),
    (None, "the a " * 150, "en"),
    (10, "É" * 40 + " A", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (6, 1, 0), (7, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]


def plain_audit(docs, labels):
    first, good, toxic = {}, set(), set()
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    for d, q, t in labels:
        if d is not None:
            good |= {d} if q == 1 else set()
            toxic |= {d} if t == 1 else set()
    parts = defaultdict(list)
    for d, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": d is not None and d > first[text],
        }
        parts[lang or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, letter in enumerate(order, 1):
                here = [r for r in left if r[0][letter]]
                left = [r for r in left if not r[0][letter]]
                failing = [r for r in rows if r[0][letter]]
                unique = sum(sum(r[0].values()) == 1 for r in failing)
                shapley[letter] += len(here)
                out[part, order, step] = (len(left), len(here), len(failing) - len(here), unique, sum(r[1] for r in here), sum(r[2] for r in here))
        for (p, order, step), v in list(out.items()):
            if p == part:
                out[p, order, step] = (*v, shapley[order[step - 1]])
    return out


def test_filter_audit(spark, sf_dir):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string").selectExpr("*", "1 as part", "2 as mask", "3 as digest", "4 as first", "5 as good").repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text", "1 as mask")
    got = [tuple(r) for r in audit.filter_audit(docs, labels).collect()]
    assert {r[:3]: r[3:] for r in got} == plain_audit(DOCS, LABELS) and len(got) == 600 * 4
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    plain = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    got = [tuple(r) for r in audit.filter_audit(docs, labels).collect()]
    assert {r[:3]: r[3:] for r in got} == plain
    assert audit.filter_audit(docs.limit(0), labels).count() == 0


def test_fields_do_not_overflow():
    mask, n = 0b1111111, (1 << 62) - 1
    total = n * audit.mask_integers()[mask] + n * audit.mask_integers()[0]
    counts = audit.unpacked(total)
    assert set(np.unique(counts).tolist()) <= {0, n}
    assert counts[:, 0, 1].tolist() == [n] * 120
