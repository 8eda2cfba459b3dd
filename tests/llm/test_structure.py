"""Conversation repair, exact top-k and periodic runs against brute force, on hard and on empty tables."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit.llm import conversation_repair, exact_topk, periodic_runs
from loomfit.llm.common import read

BLANKS = " \t\n\x0b\x0c\r"


# Conversation repair


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        out += [(conv, turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return out


def repair(rows):
    """Cheapest paths through all edits, by cost and then audit."""
    mark = lambda text: hashlib.md5(text.encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], mark(r[3])))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    legal = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
    heap, closed = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if i == len(rows) and state in "03":
            digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
            return gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest
        if (i, state) in closed:
            continue
        closed.add((i, state))
        steps = [(5, "I", 0, role, role + ":") for role in ("user", "assistant")]
        if i < len(rows):
            steps.append((2, "D", 1, None, None))
            if faults[i] not in ("b", "d"):
                extra = 5 if faults[i] == "t" else 0
                _, _, role, text = rows[i]
                steps.append((extra, "K", 1, role, f"{role}:{text}"))
                steps += [(1 + extra, "R", 1, r, f"{r}:{text}") for r in ("user", "assistant")]
        for paid, letter, taken, role, line in steps:
            after = state if role is None else legal.get((state, role[:1]))
            if after:
                heapq.heappush(heap, (cost + paid, audit + letter, i + taken, after, said + ((line,) if line else ())))


def expected(rows, ids):
    by = {conv: [] for conv in ids}
    for row in rows:
        by[row[0]].append(row)
    return {conv: repair(found) for conv, found in by.items()}


SCHEMA = "conv_id long, turn long, role string, text string, cost string, level int, end string"


def conversations(seed, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        size = rng.choice([1, 2, 3, longest])
        turns = [rng.choice([None, *range(size + 2)]) for _ in range(size)] if rng.random() < 0.3 else range(size)
        for turn in turns:
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "attendant"])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No!", "Well", " ", "", None, "a. ", "Ok?\n", "é"]) , "x", 1, "y"))
    return rows


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_repair_is_the_cheapest(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK_TURNS", block)
    rows = conversations(block)
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    hurt = damage([r[:4] for r in rows])
    assert sorted(hurt, key=str) == sorted(map(tuple, conversation_repair.damaged(df).collect()), key=str)
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(conversation_repair.damaged(df), df).collect()}
    assert found == expected(hurt, {r[0] for r in rows})


def test_repair_of_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK_TURNS", 64)
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{i}.", f"t{i}", "same."])) for i in range(3000)]
    rows += [(2, 5, "user", "again and again.")] * 500 + [(2, 6, "assistant", "done.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(df).collect()}
    assert found[2][-2] == "K" + "D" * 499 + "K" and found[2][5] == 2 * 499
    assert {1: found[1]} == expected([r for r in rows if r[0] == 1], {1})
    assert found[1][-2].count("D") + found[1][-2].count("K") + found[1][-2].count("R") == 3000


def test_repaired_turns_are_what_is_hashed(spark):
    df = spark.createDataFrame(conversations(7), SCHEMA)
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.repair(df).collect()}
    lines = {conv: [] for conv in hashes}
    for r in sorted(conversation_repair.repaired_turns(df).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert hashes == {conv: hashlib.sha256("\n".join(t).encode()).hexdigest() for conv, t in lines.items()}
    for conv, found in lines.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in found)), conv


def test_ends_are_shared(monkeypatch):
    """Each node of a shared end is computed once."""
    made = []
    make = conversation_repair.node_before
    monkeypatch.setattr(conversation_repair, "node_before", lambda *a: made.append(a[0]) or make(*a))
    words = sorted(["uaua", "ua", "saua", "suaua"], key=lambda w: w[::-1])

    class Words:  # the frame's part in solve() is to sort
        def __getattr__(self, _):
            return lambda *a: self

        def mapInArrow(self, run, _):
            import pyarrow as pa

            return list(run([pa.RecordBatch.from_pydict({"word": words, "end": [conversation_repair.END] * 4})]))

    monkeypatch.setattr(conversation_repair.F, "reverse", lambda _: Words())
    out = conversation_repair.solve(Words())[0].to_pydict()
    assert len(made) == len({w[i:] for w in words for i in range(len(w))})
    assert dict(zip(out["word"], (e[0] for e in out["edits"])))["saua"] == repair_word("saua")


def repair_word(word):
    roles = {"u": "user", "a": "assistant", "s": "system"}
    return repair([(1, i, roles[c], f"{i}.") for i, c in enumerate(word)])[-2]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.repair(df).collect() == []
    gone = conversation_repair.repair(df, spark.createDataFrame([(4,), (None,)], "conv_id long"))
    assert {tuple(r) for r in gone.collect()} == {(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (4, None)}


def test_op11_on_the_table(spark, sf):
    rows = [tuple(r) for r in read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.op11_conversation_repair(spark, sf).collect()}
    assert found == expected(damage(rows), {r[0] for r in rows})


# Exact top-k


def top(rows, asked, k=10):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (query, q) in enumerate(vectors):
        if not asked(query):
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for j, (i, v) in enumerate(vectors) if j != at]
        scored.sort(key=lambda s: s[:3])
        out += [(query, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, score string, query int, pass string"


@pytest.mark.parametrize("pass_bytes", [200, 1 << 20])
def test_top_k_is_exact(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.integers(-2, 3, rng.choice([0, 3, 6])) / 8]) for i in range(150)]
    rows += [(200, None), (None, [0.5, 0.25, 0.5]), (300, [float("nan")]), (400, [1.0, None]), (500, [float("inf"), 0.0])]
    rows += [(100, rows[100][1])] * 2 + [(-100, [0.25] * 3), (600, []), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)
    found = exact_topk.top_k(df, F.col("vec_id") % 100 == 0, pass_bytes=pass_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == top(rows, lambda i: i is not None and i % 100 == 0)


def test_top_k_of_few_or_no_rows(spark):
    assert exact_topk.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).collect() == []
    one = spark.createDataFrame([(0, [1.0], "x", 1, "y")], VECTORS)
    assert exact_topk.top_k(one, F.lit(True)).collect() == []
    assert exact_topk.top_k(one, F.lit(None).cast("boolean")).collect() == []


def test_large_components_stay_in_order(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)
    found = {r["vec_id"]: r["score"] for r in exact_topk.top_k(df, F.col("vec_id") == 0).collect()}
    assert found == {1: 2**63 - 1, 2: -(2**63), 3: 1024 * 2048, 4: 1024 * 3072}


# Periodic runs


def runs_of(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            i += 1
            part = words[start:end]
            if end - start >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    kinds, size, words = rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 3, 10, 50, 200, 400]), []
    while len(words) < size:
        if rng.random() < 0.6:
            part = [rng.randrange(kinds) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
            if rng.random() < 0.4:  # a period that is itself periodic in part
                part += [rng.randrange(kinds) for _ in range(rng.randrange(1, 4))] * rng.randrange(2, 9)
            words += (part * 9)[: int(len(part) * rng.uniform(1, 7))]
        else:
            words += [rng.randrange(kinds) for _ in range(rng.randrange(1, 20))]
    return [f"w{w}" for w in words]


def test_runs_are_all_runs(spark):
    rng = random.Random(11)
    texts = {i: repetitive(rng) for i in range(400)}
    rows = [(i, " \n".join(words), "x", "y") for i, words in texts.items()]
    found = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string"))
    for r in found.collect():
        runs = runs_of(texts[r["doc_id"]])
        assert [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == collapse(texts[r["doc_id"]], runs)


def test_long_periods(spark):
    rng = random.Random(1)
    part = [f"w{rng.randrange(3)}" for _ in range(5001)]
    text = "start " + " ".join(part * 4) + " end"
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (1, 20004, 5001) in [tuple(r) for r in row["runs"]]
    assert row["collapsed"].startswith("start") and len(row["collapsed"].split()) <= 5003


def report_of(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    words = [w.decode() for w in words]
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(collapse(words, runs))


def test_report_on_edges(spark):
    rows = [(i, " ".join(["a", "b c"] * (i % 40)) + " é" * (i % 9)) for i in range(120)]
    rows += [(None, "x " * 9), (None, None), (121, ""), (122, " \t\n"), (20, "a\x1cb " * 8), (20, "a\x1cb " * 8), (123, "q " * 30 + "r " * 30)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, best string, period int")
    found = periodic_runs.report(periodic_runs.periodic_runs(df, periodic_runs.planted(df))).collect()
    assert sorted(map(tuple, found), key=str) == sorted((report_of(*r) for r in rows), key=str)
    empty = df.limit(0)
    assert periodic_runs.report(periodic_runs.periodic_runs(empty, periodic_runs.planted(empty))).collect() == []


def test_op13_on_the_table(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "text").collect()
    small = [(r["doc_id"], r["text"]) for r in rows if len(r["text"] or "") < 6000]
    found = {r["doc_id"]: tuple(r) for r in periodic_runs.op13_periodic_runs(spark, sf).collect()}
    assert len(found) == len(rows)
    assert [found[i] for i, _ in small] == [report_of(i, text) for i, text in small]
