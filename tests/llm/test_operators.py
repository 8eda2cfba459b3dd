"""Each operator against brute force, on edge tables and on small texts."""

import collections
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomfit.llm import (
    compression_licenses,
    context_mixing,
    jaccard_join,
    language_codes,
    length_buckets,
    quality_rules,
    revisits,
    subsequence_toxicity,
    templates,
    token_scan,
)
from loomfit.llm.common import FOLDED, Cells, Spans

SCHEMA = "doc_id long, text string, lang string, score string, node string"
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
EDGES = [
    (1, None, "en", "x", "y"),
    (2, "", "en", "x", None),
    (3, " \n\t", None, "x", "y"),
    (4, "one", "en", "x", "y"),
    (5, LONG, "fr", "x", "y"),
    (6, "a b c d e f", "en", "x", "y"),
    (7, "A B c d  e\nf", "en", "x", "y"),
    (7, "A B c d  e\nf", "en", "x", "y"),
    (None, "a b c d e f", "en", "x", "y"),
    (8, "Éa öb ### 12 |", "fr", None, "y"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_spans_are_the_words():
    texts = [b"", b"  ", b" a B", "é\x0bx\x1cy ".encode(), b"q"]
    for begin in range(2):
        spans = Spans(pa.array(texts, pa.binary()).slice(begin))
        for i, text in enumerate(texts[begin:]):
            assert [spans.word(k) for k in range(*spans.offsets[i : i + 2])] == text.split()
    spans = Spans(pa.array([b"the The THE then"], pa.binary()))
    assert len(set(spans.hashes(FOLDED)[:3].tolist())) == 1 and len(set(spans.hashes().tolist())) == 4


def test_cells_pass_all_they_were_built_from(spark):
    numbers = [0, -1, 5, 2**62, -(2**63), 2**63 - 1]
    cells = Cells(spark.createDataFrame([(n,) for n in numbers], "n long"), 20)
    assert cells.holds(np.array(numbers, np.int64)).all()
    assert not cells.holds(np.array([2**61, -(2**61)], np.int64)).any()


# 1 ----------------------------------------------------------------------------------------------


def brute_repeats(words):
    seen = collections.defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)})


def test_quality_counts(spark, edges, none):
    rows = by_id(quality_rules.quality(edges))
    for doc, text, *_ in EDGES:
        words = (text or "").split()
        assert rows[doc]["n_words"] == len(words)
        assert rows[doc]["word_chars"] == sum(map(len, words))
        assert rows[doc]["n_repeat_words"] == brute_repeats(words)
        assert rows[doc]["base_failed"] == (len(words) < 20 or 100 * brute_repeats(words) > 30 * len(words))
    assert rows[8]["n_symbols"] == 4
    assert quality_rules.quality(none).count() == 0
    text = "of the a b c d e f g h\nof the a b c d e f g h\n \nx\nx"
    row = quality_rules.quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_dup_lines"], row["n_repeat_words"]) == (2, brute_repeats(text.split()))


def test_quality_verdict(spark):
    clean = "This is the story of a small town by the sea and of the people that live in it with joy every day."
    junk = " ".join(f"$$$ w{i} ###" for i in range(30))
    rows = by_id(quality_rules.quality(spark.createDataFrame([(1, clean), (2, junk)], "doc_id long, text string")))
    assert rows[1]["kept"] and not rows[2]["kept"] and "symbol_ratio" in rows[2]["failed"]


# 2 ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block,run", [(2, 2), (6, 3), (10, 4096), (1 << 20, 4096)])
def test_token_scan_stitches_blocks(spark, block, run):
    rng = np.random.default_rng(block)
    files = {"a": [3, 0, 9, 1, 0, 0], "b": [0], "c": [25], "d": [], "e": rng.integers(0, 7, 40).tolist()}
    rows, want = [], []
    for name, lengths in files.items():
        ids = [t for n in lengths for t in [*range(1, n + 1), 0]] + ([7, 7] if name == "c" else [])
        raw = np.array(ids, "<u2").tobytes()
        rows += [(name, i // block, bytearray(raw[i : i + block])) for i in range(0, len(raw), block)]
        want += [(name, i, n, True) for i, n in enumerate(lengths)]
    want.append(("c", 1, 2, False))
    blocks = spark.createDataFrame(rows, "file string, block long, bytes binary")
    found = token_scan.scan_documents(token_scan.summarise(blocks), run)
    assert sorted(tuple(r) for r in found.select("file", "doc_no", "n_tokens", "ended").collect()) == sorted(want)


def test_token_files_round_trip(spark, edges, tmp_path):
    path = str(tmp_path / "tokens")
    token_scan.write_token_files(token_scan.encode(edges.coalesce(1)), path)
    found = token_scan.count_tokens(spark, path, 64).orderBy("file", "doc_no").collect()
    encoder = token_scan._encoder(token_scan.TOKENIZER)
    assert [r["n_tokens"] for r in found] == [len(encoder.encode_ordinary(row[1] or "")) for row in EDGES]


# 3 ----------------------------------------------------------------------------------------------


def test_toxicity_learns_insults_and_edges(spark, edges, none):
    rng = np.random.default_rng(3)
    calm = [f"{a}{b}{c}" for a in ("mel", "tor", "ban") for b in ("a", "o", "i") for c in ("nt", "sk", "rd", "le")]
    bad = ["worthless", "pathetic", "disgusting"]
    rows = []
    for i in range(400):
        words = rng.choice(calm, 30).tolist()
        if i % 5 == 0:
            words[3:3] = rng.choice(bad, 2).tolist()
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    model = subsequence_toxicity.ToxicWords.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    margin = dict(zip("worthless wor-thless worthxless melant".split(), model.margins([b"worthless", b"wor-thless", b"worthxless", b"melant"])))
    assert margin["worthless"] == margin["wor-thless"] > margin["melant"] and margin["worthxless"] > margin["melant"]
    test = [(1, "melant torosk banile PATHETIC, worthless! melant", 1), (2, "melant torosk banile melant banint", 0)]
    scored = by_id(model.score(spark.createDataFrame(test, "doc_id long, text string, toxic int")))
    assert scored[1]["predicted"] == 1 and scored[2]["predicted"] == 0
    assert {r["doc_id"] for r in model.score(edges).collect()} == {r[0] for r in EDGES}
    assert model.score(none).count() == 0
    blank = subsequence_toxicity.ToxicWords.fit(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert all(r["predicted"] == 0 for r in blank.score(edges).collect())


def test_toxicity_held_out(spark, sf):
    rows = subsequence_toxicity.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    clean = rows.filter("held_out and toxic = 0")
    assert clean.filter("predicted = 1").count() <= 0.1 * clean.count()


# 4 ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 12])
def test_codewords_are_apart(n):
    code = language_codes.code_matrix(n).astype(int)
    assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 1
    assert all(abs(column.sum()) < n for column in code.T)


def test_language_id(spark, sf, edges, none):
    found = language_codes.op4_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    held = found.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
    rows = by_id(language_codes.LanguageCodes.fit(edges).predict(edges))
    assert all(rows[i]["lang_pred"] == "und" for i in (1, 2, 3)) and rows[5]["lang_pred"] == "fr"
    assert language_codes.LanguageCodes.fit(none).predict(edges).filter("lang_pred <> 'und'").count() == 0
    assert language_codes.LanguageCodes.fit(edges).predict(none).count() == 0


def test_language_margins_do_not_depend_on_the_batch(edges):
    code = language_codes.LanguageCodes._from_counts(["a", "b", "c"], np.random.default_rng(1).random((3, 1 << language_codes.BITS)))
    texts = [b"one text", b"", b"another much longer text " * 20_000, b"x"]
    together = code.margins(texts)
    for text, row in zip(texts, together):
        assert np.allclose(code.margins([text])[0], row)


# 5 ----------------------------------------------------------------------------------------------


def test_canonical_url(spark):
    cases = {
        "HTTP://Ex.com:80/a/?b=2&a=1&utm_source=q#t": "ex.com/a?a=1&b=2",
        "https://ex.com": "ex.com",
        "https://ex.com/?gclid=1": "ex.com",
        "not a url": "not a url",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert [r[0] for r in df.select(revisits.canonical_url(F.col("u"))).collect()] == list(cases.values())


def test_revisits_edges(spark):
    u = "http://a.com/x"
    log = [
        (1, u, 10, 200, {"ETag": '"1"', "Content-Type": "t", "Date": "10"}),
        (2, "https://A.com/x#f", 20, 304, {"etag": 'W/"1"', "date": "20", "content-length": "0"}),
        (3, u, 30, 304, {"etag": '"2"'}),
        (4, u, 5, 304, None),
        (5, u, 40, 304, {"date": None}),
        (6, None, 40, 304, {"etag": '"1"'}),
        (7, u, None, 304, None),
        (8, u, 50, 200, None),
        (9, u, 50, 304, {"etag": '"1"'}),
        (10, u, 60, 404, None),
        (11, "http://b.com", 1, 304, {"last-modified": "m"}),
    ]
    df = spark.createDataFrame(log, "record_id long, url string, ts long, status int, headers map<string,string>")
    rows = {r["record_id"]: r for r in revisits.resolve(df.withColumn("part", F.lit(1))).collect()}
    outcomes = {i: (r["outcome"], r["target_id"]) for i, r in rows.items()}
    assert outcomes == {
        2: ("resolved", 1), 3: ("mismatch", 1), 4: ("missing", None), 5: ("unchecked", 1), 6: ("missing", None),
        7: ("missing", None), 9: ("mismatch", 8), 11: ("missing", None),
    }
    assert rows[2]["headers"] == {"content-type": "t", "date": "20", "etag": 'W/"1"'}
    assert revisits.resolve(df.limit(0)).count() == 0


def test_revisits_with_repeated_names_and_equal_places(spark):
    u, v = "http://a.com/x", "http://a.com/y"
    log = [
        (1, u, 10, 200, {"ETag": '"1"', "etag": '"2"', "eTag": '"0"'}),
        (2, u, 20, 304, {"etag": '"3"', "ETAG": '"1"'}),
        (5, v, 30, 200, {"etag": '"5"'}),
        (5, v, 30, 304, {"etag": '"5"'}),
        (6, v, 40, 304, {"etag": '"5"'}),
        (7, v, 50, 200, {"etag": '"7"', "a": "b"}),
        (7, v, 50, 200, {"etag": '"7"', "a": "c"}),
        (8, v, 60, 304, {"etag": '"7"'}),
        (None, v, 60, 304, {"etag": '"7"'}),
    ]
    df = spark.createDataFrame(log, "record_id long, url string, ts long, status int, headers map<string,string>")
    seen = set()
    for order in (F.asc("record_id"), F.desc("record_id"), F.rand(3)):
        rows = revisits.resolve(df.repartition(3).orderBy(order)).collect()
        found = {r["record_id"]: (r["outcome"], r["target_id"]) for r in rows}
        assert found == {2: ("resolved", 1), 5: ("missing", None), 6: ("resolved", 5), 8: ("resolved", 7), None: ("resolved", 7)}
        seen.add(next(r["headers"]["a"] for r in rows if r["record_id"] == 8))
    assert len(seen) == 1


# 6 ----------------------------------------------------------------------------------------------


def test_word_scores_and_tokens(spark, edges, none):
    train = F.coalesce(F.col("doc_id"), F.lit(0)) != 5
    rows = context_mixing.score(edges, train).collect()
    tokens = {r[0]: [*(r[1] or "").encode().lower().split(), None] for r in EDGES}
    counts = collections.Counter(w for r in EDGES if r[0] != 5 for w in tokens[r[0]])
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(EDGES)
    for r in rows:
        words = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    assert context_mixing.score(none, train).count() == 0


def test_mixer_is_a_probability(monkeypatch):
    """The chances of all next bytes add up to one, and known text costs less than strange text."""
    tables = [np.random.default_rng(k).integers(-60, 60, 16 << bits).astype(np.int8) for k, bits in enumerate(context_mixing.SLOT_BITS)]
    model = context_mixing.ContextMixer(tables)
    data = np.arange(256, dtype=np.uint8)
    contexts = np.repeat(np.array([[7], [8], [9], [10]], np.uint64) << np.uint64(50), 256, axis=1)
    odds, bits = model._look_up(contexts, data)
    mixed = (odds.astype(float) / context_mixing.STEP).sum(axis=0) * context_mixing.FIRST_WEIGHT
    p = 1 / (1 + np.exp(-mixed))
    assert math.isclose(np.prod(np.where(bits > 0, p, 1 - p), axis=0).sum(), 1, rel_tol=1e-6)
    texts = pa.array([b"one two", b"", b"x" * 5000], pa.binary())
    together = model.log10(context_mixing.Bytes(Spans(texts)))
    alone = np.concatenate([model.log10(context_mixing.Bytes(Spans(texts.slice(i, 1)))) for i in range(3)])
    assert np.allclose(together, alone, rtol=1e-4)


def test_mixer_equals_plain_loops():
    """Contexts, one fetch per half byte, and weights refined bit by bit, against loops over Python numbers."""
    rng = np.random.default_rng(6)
    tables = [rng.integers(-127, 128, 16 << bits).astype(np.int8) for bits in context_mixing.SLOT_BITS]
    model = context_mixing.ContextMixer(tables)
    for k, value in ((0, 0), (1, 5), (3, 15)):
        nodes = [(1 << depth) + (value >> (4 - depth)) for depth in range(4)]
        path = model.paths[k].reshape(-1, 16)[:, value].copy().view(np.int8).reshape(-1, 4)
        assert np.array_equal(path, tables[k].reshape(-1, 16)[:, nodes])
    long = b"w" * (context_mixing.PIECE - 3) + b" Over the edge of a piece " + bytes(rng.integers(97, 123, 900).astype(np.uint8))
    texts = [b"One two  one", b"", long, "zwölf\tdrei".encode(), b"a b c"]
    text = context_mixing.Bytes(Spans(pa.array(texts, pa.binary())))
    found, ones = model.log10(text), (1 << 64) - 1

    def mixed(value):
        value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & ones
        value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & ones
        return value ^ (value >> 31)

    token = 0
    for raw in texts:
        words = [w.lower() + b" " for w in raw.split()] + [b"\n"]
        data, place, total, sums = b"".join(words), [i for w in words for i in range(len(w))], 0.0, []
        ends = set(np.cumsum([len(w) for w in words]))
        word, power = 0, 1
        for i, byte in enumerate(data):
            if i % context_mixing.LANE == 0:
                weights = np.full((8, len(tables)), context_mixing.FIRST_WEIGHT)
            if place[i] == 0:
                word, power = 0, 1
            power = power * 0x2545F4914F6CDD1D & ones
            hashes = [sum((data[i - j] + 1) << (9 * (j - 1)) for j in range(1, n + 1) if i >= j) for n in (2, 3, 5)] + [word]
            hashes = [mixed((h + ((k + 1) << 56)) & ones) for k, h in enumerate(hashes)]
            word = (word + (byte + 1) * power) & ones
            seconds = [(h ^ ((byte >> 4) + 1)) * 0x9E3779B97F4A7C15 & ones for h in hashes]
            for bit in range(8):
                half = byte >> 4 if bit < 4 else byte & 15
                node = (1 << bit % 4) + (half >> (4 - bit % 4))
                at = [(h >> (64 - bits)) * 16 + node for h, bits in zip(hashes if bit < 4 else seconds, context_mixing.SLOT_BITS)]
                odds = np.array([float(table[a]) for table, a in zip(tables, at)]) / context_mixing.STEP
                p = 1 / (1 + math.exp(-min(max(float(weights[bit] @ odds), -context_mixing.CLIP), context_mixing.CLIP)))
                actual = byte >> (7 - bit) & 1
                total += math.log10(p if actual else 1 - p)
                weights[bit] += context_mixing.RATE * (actual - p) * odds
            if i + 1 in ends:
                sums.append(total)
                total = 0.0
        assert np.allclose(found[token : token + len(words)], sums, rtol=1e-4, atol=1e-3)
        token += len(words)
    assert token == len(found)


# 7 ----------------------------------------------------------------------------------------------


def test_buckets_are_optimal():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 9):
        lengths, counts = np.sort(rng.choice(50, n, replace=False)), rng.integers(1, 9, n)

        def padding(ends, lengths=lengths, counts=counts):
            return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))

        import itertools

        for k in (1, 2, 3):
            best = min(
                padding([*cut, lengths[-1]]) for cut in itertools.combinations(lengths[:-1], min(k, n) - 1)
            )
            assert padding(length_buckets.optimal_lengths(lengths, counts, k)) == best
    assert length_buckets.optimal_lengths(np.zeros(0), np.zeros(0)) == []


def test_pack_keeps_every_token(spark, edges, none):
    rows = length_buckets.pack(edges, length_buckets.word_count(F.col("text")), 3, 512, 1024).collect()
    assert sum(r["length"] for r in rows) == sum(len((r[1] or "").split()) for r in EDGES)
    sizes = collections.Counter((r["bucket"], r["batch"]) for r in rows)
    for (bucket, _), n in sizes.items():
        assert n <= max(1, 1024 // max(1, bucket))
    assert all(r["length"] <= r["bucket"] for r in rows)
    assert length_buckets.pack(none, length_buckets.word_count(F.col("text"))).count() == 0


# 8 ----------------------------------------------------------------------------------------------

ITEM = "A train leaves the old station with 120 people and travels for 3 hours before 120 people step off, says Anna."
OTHER = ITEM.replace("120", "75").replace("3 hours", "9 hours").replace("Anna", "Boris")
WRONG = ITEM.replace("120", "75", 1).replace("Anna", "Boris")


def test_templates_find_other_values(spark, edges, none):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "5 6 7"), (9, OTHER)], "item_id long, text string")
    docs = [(10, f"Some words first. {OTHER} And some after."), (11, f"Here now: {WRONG}"), (12, "the old station with people")]
    found = templates.leaks(spark.createDataFrame([*docs, docs[0]], "doc_id long, text string"), items).collect()
    assert [(r["doc_id"], r["item_id"], r["n_items"]) for r in found] == [(10, 1, 2)]
    assert templates.leaks(edges, items).count() == 0
    assert templates.leaks(none, items).count() == 0 and templates.leaks(edges, items.limit(0)).count() == 0


def leaked(spark, items, docs):
    items = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(docs)], "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in templates.leaks(docs, items).collect()}


def test_templates_find_values_and_parts(spark):
    table = "12 7 1999 44.5 Anna Berta 3 kg 88 102 71 5 16 23"
    long = " ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(39))
    short = [" ".join(f"short{chr(97 + n)}{chr(97 + k)}" for k in range(n)) for n in (16, 18, 20)]
    changed = [" ".join("other" if k == n // 2 else w for k, w in enumerate(t.split())) for t in short for n in [len(t.split())]]
    docs = [f"Here: {table} and more", table.replace("44.5", "44.6").replace("88", "89"), " ".join(long.split()[12:27]), *changed]
    docs += [" ".join(long.split()[:9]), "12 7 1999 and the rest of it"]
    assert leaked(spark, [table, long, *short], docs) == {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_templates_find_names_that_begin_sentences(spark):
    items = [
        "Anna has 12 apples. Anna gives 3 to Tom.",
        "Every evening the old keeper called Anna walks along the wall and counts 7kg of stones there.",
        "Where does the quiet river end?",
    ]
    docs = [
        "Well. Ben has 12 apples. Ben gives 3 to Ed.",
        "Every evening the old keeper called Mary Ann walks along the wall and counts 5 kg of stones there.",
        "a line without an end\nWhere does the quiet river end? Yes.",
        "they asked Where does the quiet river end? Yes.",
        "Ben has 12 pears. Ben takes 3 from Ed.",
    ]
    assert leaked(spark, items, docs) == {(0, 0), (1, 1), (2, 2), (3, 2)}


def test_templates_find_whole_items(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["doc_id"]: " ".join(r["text"].lower().split()) for r in docs.collect()}
    want = {(d, r["item_id"]) for r in items.collect() for d, t in texts.items() if " ".join(r["text"].lower().split()) in t}
    got = {(r["doc_id"], r["item_id"]) for r in templates.leaks(docs, items).collect()}
    assert want and want <= got and len(got - want) <= 0.2 * len(want)


# 9 ----------------------------------------------------------------------------------------------


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, same = len(sets[i] & sets[j]), rows[i][0] == rows[j][0] and rows[i][0] is not None
            if sets[i] and sets[j] and (same or 100 * both >= percent * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc), doc)
    return [(doc, len(sets[i]), lowest.get(find(i))) for i, (doc, _) in enumerate(rows)]


def _family(rng, vocabulary, n_words, members, most):
    base = rng.choice(vocabulary, n_words).tolist()
    for _ in range(members):
        copy = list(base)
        for at in rng.integers(0, n_words, rng.integers(0, most + 1)):
            copy[at] = str(rng.choice(vocabulary))
        yield " ".join(copy)


@pytest.mark.parametrize("hot", [64, 3])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, hot):
    """Families of near copies, with a passage that many share; a small HOT makes nodes deep."""
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rng = np.random.default_rng(9)
    vocabulary = np.array([f"v{i}" for i in range(400)])
    passage = " ".join(rng.choice(vocabulary, 30))
    texts = [t for n in (12, 60, 150) for t in _family(rng, vocabulary, n, 25, 6)]
    texts += [f"{passage} {' '.join(rng.choice(vocabulary, int(k)))}" for k in rng.integers(1, 60, 30)]
    texts += [None, "", "one", "one", "two", "a b", "A  B", "a b c"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((4, 85), (5, 80)):
        got = [tuple(r) for r in jaccard_join.near_duplicates(df, words, percent).collect()]
        assert sorted(got) == sorted(brute_components(rows, words, percent))


def test_jaccard_join_edges(edges, none):
    rows = [(r[0], r[1]) for r in EDGES]
    got = [tuple(r) for r in jaccard_join.near_duplicates(edges).collect()]
    assert sorted(got, key=str) == sorted(brute_components(rows, 5, 80), key=str)
    assert jaccard_join.near_duplicates(none).count() == 0


# 10 ---------------------------------------------------------------------------------------------


def test_license_scan(spark, edges, none):
    texts = [
        "Some text.\nReleased under the MIT License.\nMore.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 7.",
        "LICENSED  under the Apache License, Version 2.0",
        "You need a license to drive a car, and permission to park it here.",
        f"{LONG} Licensed under CC BY-NC 4.0. {LONG}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in compression_licenses.scan(docs.withColumn("license", F.lit("z"))).collect()}
    assert {i: r["license"] for i, r in found.items()} == {0: "MIT", 1: "GPL-2.0", 3: "Apache-2.0", 5: "CC-BY-NC-4.0"}
    assert found[0]["line"] == 1 and found[0]["missing"] == 0 and found[0]["differences"] == ""
    assert compression_licenses.scan(edges).count() == 0 and compression_licenses.scan(none).count() == 0


def test_license_notices_go_over_lines(spark):
    long = [i for i, (_, text) in enumerate(compression_licenses.TEMPLATES) if len(text.split()) > 15]
    assert len(long) >= 4
    texts = {}
    for i in long:
        words = compression_licenses.TEMPLATES[i][1].split()
        wrapped = "\n".join("# " + " ".join(words[k : k + 7]) for k in range(0, len(words), 7))
        for before in (0, 90, 130, 180):
            texts[1000 * before + i] = " ".join(f"b{k}" for k in range(before)) + f"\nand\n{wrapped.upper() if before else wrapped}\nend"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = [(r["doc_id"], r["line"], r["license"], r["missing"], r["extra"]) for r in compression_licenses.scan(docs).collect()]
    assert sorted(found) == sorted((d, 2, compression_licenses.TEMPLATES[d % 1000][0], 0, 0) for d in texts)


def test_license_scan_returns_every_notice(spark):
    notices = [text for _, text in compression_licenses.TEMPLATES]
    texts = ["Released under the MIT License. Licensed under CC BY 4.0.", " ".join(notices), "\n".join(notices)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["line"], r["license"]) for r in compression_licenses.scan(docs).collect()}
    licenses = [name for name, _ in compression_licenses.TEMPLATES]
    want = {(0, 0, "MIT"), (0, 0, "CC-BY-4.0"), *[(1, 0, name) for name in licenses]}
    assert found == want | {(2, line, name) for line, name in enumerate(licenses)}


def test_license_rows_keep_their_ids(spark):
    texts = ["Released under the MIT License.", "Licensed under CC BY 4.0.", "Licensed under CC BY 4.0."]
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), ("x", texts[2]), ("x", texts[2])], "doc_id string, text string")
    clash = docs.withColumn("line", F.lit(9)).withColumn("template", F.lit("t")).withColumn("matched", F.lit(0))
    found = sorted(((r["doc_id"], r["line"], r["license"]) for r in compression_licenses.scan(clash).collect()), key=str)
    assert found == [("x", 0, "CC-BY-4.0")] * 2 + [(None, 0, "CC-BY-4.0"), (None, 0, "MIT")]


def test_license_ties():
    """Of two templates with equal words the first one listed counts, and of two notices the first one."""
    templates = [("B", "Copyright one two three"), ("B", "Copyright  one TWO three"), ("A", "copyright one two three")]
    scanner = compression_licenses.Scanner(templates, 0.8)
    found = scanner.find_all("copyright one two three and copyright one two three".split())
    assert [(f.template, f.places[0]) for f in found] == [(0, 0), (0, 5)]


def altered(rng, scanner, i, words, most_extra):
    """A template's words with some left out and some put in, amid other words."""
    notice = list(scanner.words[i])
    for _ in range(rng.integers(0, scanner.may_miss[i] + 1)):
        notice.pop(int(rng.choice([k for k, w in enumerate(notice) if not w.isdigit()])))
    for _ in range(rng.integers(0, min(most_extra, scanner.spans[i] - len(notice)) + 1)):
        notice.insert(int(rng.integers(1, len(notice))), str(rng.choice(words)))
    before, after = rng.integers(0, 150, 2)
    return [*rng.choice(words, before), *notice, *rng.choice(words, after)], int(before)


def brute_alignment(have, want, most, span):
    """The least sum of missing words and words put in, over all stretches of a text."""
    best = None
    for a in range(len(have)):
        # common[j]: most words in common of the stretch and the first j of the template, numbers included
        common = [0] + [None] * len(want)
        for j, w in enumerate(want):
            common[j + 1] = None if w.isdigit() else common[j]
        for b in range(a, min(len(have), a + span)):
            new = [0]
            for j, w in enumerate(want):
                options = [common[j + 1], None if w.isdigit() else new[j]]
                if w == have[b] and common[j] is not None:
                    options.append(common[j] + 1)
                new.append(max((o for o in options if o is not None), default=None))
            common = new
            if common[-1] is not None and len(want) - common[-1] <= most:
                cost = len(want) - common[-1] + (b - a + 1) - common[-1]
                best = cost if best is None else min(best, cost)
    return best


def test_license_alignment_equals_brute_force():
    rng = np.random.default_rng(5)
    templates = [("A", "a license b 2 c d"), ("B", "license b b c"), ("C", "x license 4 0"), ("D", "a b c d e license f g h i j")]
    scanner = compression_licenses.Scanner(templates, 0.7, 2.0)
    letters = [*"abcdefghij", "license", "license", "2", "4", "0"]
    hits = 0
    for _ in range(300):
        have = [str(w) for w in rng.choice(letters, rng.integers(0, 25))]
        for i, want in enumerate(scanner.words):
            compared, best = scanner.compare(have, i), brute_alignment(have, want, scanner.may_miss[i], scanner.spans[i])
            assert (compared is None) == (best is None)
            if compared:
                hits += 1
                places, missing = compared
                assert [have[p] for p in places] + missing and sorted(missing + [have[p] for p in places]) == sorted(want)
                assert len(missing) + places[-1] - places[0] + 1 - len(places) == best
    assert hits > 40


def test_compression_decides_and_loses_little():
    """Of notices with words left out and put in, the savings let through what the alignment alone finds."""
    rng = np.random.default_rng(6)
    words = np.array([f"{a}{b}{c}" for a in ("st", "mo", "la", "ker") for b in ("on", "i", "ure") for c in ("d", "ts", "ly", "")])
    ranked = compression_licenses.Scanner(compression_licenses.TEMPLATES, compression_licenses.AGREEMENT)
    every = compression_licenses.Scanner(compression_licenses.TEMPLATES, compression_licenses.AGREEMENT, saves=0.0)
    every.needed = [-1e9] * len(every.words)  # no template is ruled out
    found = all_found = exact = 0
    for _ in range(8):
        for i in range(len(ranked.words)):
            have, begin = altered(rng, ranked, i, words, 3)
            a, b = ({(f.license, f.places) for f in s.find_all(have)} for s in (ranked, every))
            assert a <= b
            found, all_found = found + len(a), all_found + len(b)
            verbatim = [*have[:begin], *ranked.words[i], "end"]
            exact += any(f.template == i and not f.differences for f in ranked.find_all(verbatim))
    assert exact == 8 * len(ranked.words) and found >= 0.99 * all_found > 0
    ranked.saved = every.saved
    ranked.with_template = [ranked.plain] * len(ranked.words)  # no dictionary saves anything
    ranked.known.clear()
    assert not ranked.find_all(ranked.words[1])


def test_license_differences():
    scanner = compression_licenses.Scanner(compression_licenses.TEMPLATES, compression_licenses.AGREEMENT)
    found = scanner.find("Released today under the MIT License.")
    assert (found.license, found.missing, found.extra, found.differences) == ("MIT", 0, 1, "+today")


def test_held_out_parts(spark):
    from loomfit.llm.common import id_hash

    rows = spark.range(50).select("id", id_hash(F.col("id"), 5).alias("part")).collect()
    assert all(r["part"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_a_large_vocabulary_takes_little_memory():
    """The toxicity machine is fitted on the driver: its words as cells and weights must stay small there."""
    words = [f"\x01word{i}\x02" for i in range(4000)]
    tracemalloc.start()
    cells, weights = subsequence_toxicity.subsequences(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3000 * len(words)
    assert np.allclose((weights * weights).sum(axis=1), 1, atol=1e-5) and cells.max() < 1 << subsequence_toxicity.BITS
