"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words sums over the subsequences of three letters they share, each weighted by
``DECAY`` to the power of the letters it skips, so a word with letters put in or left out stays
near. A word is mapped to its kernel values with landmark words, made orthonormal by the inverse root
of the landmarks' kernel matrix, and a linear machine separates insults from other words there. That
map is linear in the subsequence weights, so the fitted machine folds into one weight per subsequence
and a word is scored without touching the landmarks. A text's score is a logistic curve over the
margins of its three most toxic words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_hash, keep, query, read, small_batches, text_bytes

DECAY = 0.8
SPAN = 6  # letters from the first to the last of a subsequence, skipped ones included
BITS = 16  # subsequences are hashed into 2**BITS cells
WIDTH = 24  # letters of a word handled at once, with its two ends; longer words go in overlapping parts
PAIRS = tuple((a, b) for b in range(2, SPAN) for a in range(1, b))
SAMPLE_DOCS = 20_000  # bound of the labelled documents that the machine is fitted on
LANDMARKS = 512
BLOCK = 32  # landmarks whose kernel values are found together
NEGATIVES = 16_000  # words of clean documents that the machine is fitted on
COST = 100.0
ALTERED_COST = 0.3  # share of that for words with a letter put in
TOP = 3  # most toxic words of a text that its score looks at
FLOOR = -3.0  # margins below it, and missing words, count as it
KNOWN_WORDS = 400_000  # scores a task remembers
_SPELLED = re.compile(rb"(?:^|(?<=\s))(?:[^\s]\s){3,}[^\s](?=\s|$)")  # letters set apart by single spaces


def units(text: bytes) -> list[bytes]:
    """The lower-case words of a text, and its spelled-out words put together."""
    text = text.lower()
    words = text.split()
    for found in _SPELLED.findall(text):
        words.append(b"".join(found.split()))
    return words


def letters(word: bytes) -> str:
    """The letters and digits of a word between its two ends."""
    kept = "".join(c for c in str(word, "utf-8", "replace").lower() if c.isalnum())
    return f"\x01{kept}\x02" if kept else ""


def _parts(word: str) -> list[str]:
    step = WIDTH // 2
    return [word[i : i + WIDTH] for i in range(0, max(1, len(word) - step), step)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells and kernel weights of the subsequences of each word of at most WIDTH letters, scaled to length one."""
    codes = np.zeros((len(words), WIDTH + SPAN), dtype=np.uint32)
    for row, word in enumerate(words):
        codes[row, : len(word)] = [ord(c) for c in word]
    first = codes[:, :WIDTH]
    cells = np.empty((len(words), len(PAIRS) * WIDTH), dtype=np.uint16)  # BITS fit; a large vocabulary passes here at once
    weights = np.empty(cells.shape, dtype=np.float32)
    for k, (a, b) in enumerate(PAIRS):
        second, third = codes[:, a : a + WIDTH], codes[:, b : b + WIDTH]
        h = ((first * np.uint32(0x9E3779B1) + second) * np.uint32(0x85EBCA77) + third) * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x27D4EB2F)
        part = slice(k * WIDTH, (k + 1) * WIDTH)
        cells[:, part] = h >> np.uint32(32 - BITS)
        weights[:, part] = np.where(third > 0, np.float32(DECAY ** (b - 2)), np.float32(0))
    norm = np.sqrt(np.einsum("wf,wf->w", weights, weights))[:, None]
    weights /= np.maximum(norm, np.float32(1e-9))
    return cells, weights


def _blocks(cells: np.ndarray, weights: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The given words as columns over all cells, some words at a time, so that memory stays small."""
    for begin in range(0, len(cells), BLOCK):
        block = slice(begin, min(begin + BLOCK, len(cells)))
        out = np.zeros((1 << BITS, block.stop - begin), dtype=np.float32)
        for column, (at, weight) in enumerate(zip(cells[block], weights[block])):
            np.add.at(out[:, column], at, weight)
        yield block, out


def kernel(cells: np.ndarray, weights: np.ndarray, landmark_cells: np.ndarray, landmark_weights: np.ndarray) -> np.ndarray:
    """Kernel values of words with landmarks, both given as cells and weights."""
    out = np.empty((len(cells), len(landmark_cells)), dtype=np.float32)
    for block, columns in _blocks(landmark_cells, landmark_weights):
        for begin in range(0, len(cells), 128):
            part = slice(begin, begin + 128)
            out[part, block] = np.einsum("wf,wfm->wm", weights[part], columns[cells[part]])
    return out


def _machine(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps on the rows inside the margin; the last weight is the bias."""
    size = z.shape[1] + 1
    w = np.zeros(size)
    ridge = np.ones(size)
    ridge[-1] = 1e-3
    for _ in range(40):
        inside = np.flatnonzero(y * (z @ w[:-1].astype(z.dtype) + w[-1]) < 1)
        square, target = np.diag(ridge), np.zeros(size)
        for begin in range(0, len(inside), 1024):
            rows = inside[begin : begin + 1024]
            part = np.column_stack([z[rows].astype(float), np.ones(len(rows))])
            weighted = part * cost[rows, None]
            square += weighted.T @ part
            target += weighted.T @ y[rows]
        new = np.linalg.solve(square, target)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _altered(word: str) -> list[str]:
    """The word with one strange letter put in, at three places; short words have too little to know them by."""
    if len(word) < 4:
        return []
    places = sorted({len(word) // 4 + 1, len(word) // 2, len(word) - 1 - len(word) // 4})
    return [word[:i] + "x10"[k % 3] + word[i:] for k, i in enumerate(places)]


def _cover(rows: dict[int, set[str]], least: int, later: int) -> list[str]:
    """Words that cover each toxic document up to TOP times, the one that covers most first.

    A word must cover ``least`` documents, or ``later`` ones if all of them are covered already.
    """
    where: dict[str, set[int]] = {}
    for doc, words in rows.items():
        for word in words:
            where.setdefault(word, set()).add(doc)
    left = dict.fromkeys(rows, TOP)
    chosen = []
    while where:
        word = max(where, key=lambda w: (len(where[w]), w))
        found = where.pop(word)
        if len(found) < (least if any(left[doc] == TOP for doc in found) else later):
            break
        chosen.append(word)
        done = set()
        for doc in found:
            left[doc] -= 1
            if not left[doc]:
                done.add(doc)
        if done:
            where = {w: rest for w, docs in where.items() if (rest := docs - done)}
    return chosen


@dataclass
class ToxicWords:
    """A fitted machine: a weight per subsequence cell, a bias, and the curve that makes margins chances."""

    theta: np.ndarray = field(repr=False)
    bias: float
    curve: np.ndarray = field(default_factory=lambda: np.array([1.0] + [0.0] * TOP))

    def margins(self, words: list[bytes]) -> np.ndarray:
        """The machine's margin for each word; words without letters are as far from toxic as can be."""
        out = np.full(len(words), -1e3, dtype=np.float32)
        owners, parts = [], []
        for i, word in enumerate(words):
            if kept := letters(word):
                if len(kept) <= WIDTH:
                    owners.append(i)
                    parts.append(kept)
                else:
                    for part in _parts(kept):
                        owners.append(i)
                        parts.append(part)
        for begin in range(0, len(parts), 4096):
            cells, weights = subsequences(parts[begin : begin + 4096])
            values = (self.theta[cells] * weights).sum(axis=1) + self.bias
            np.maximum.at(out, owners[begin : begin + 4096], values)
        return out

    def texts(self, texts: list[bytes], known: dict[bytes, float]) -> np.ndarray:
        """The TOP largest margins of the words of each text. ``known`` remembers words between calls."""
        split = [set(units(t)) for t in texts]
        new = set().union(*split) - known.keys()
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = set().union(*split)
        new = list(new)
        known.update(zip(new, self.margins(new).tolist()))
        out = np.full((len(texts), TOP), FLOOR)
        for row, words in zip(out, split):
            top = nlargest(TOP, map(known.__getitem__, words))
            row[: len(top)] = top
        return np.clip(out, FLOOR, -FLOOR)

    def chance(self, tops: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(tops @ self.curve[:-1] + self.curve[-1], -30, 30)))

    @classmethod
    def fit(cls, labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 0) -> ToxicWords:
        """Learn from rows (doc_id, text, toxic); null labels are left out.

        At most about ``sample_docs`` documents, picked by a hash of their id, are used: they bound what
        the driver gets. Without both labels the model scores every text 0.
        """
        labelled = labelled.filter(F.col("toxic").isNotNull())
        n = labelled.count()
        share = min(1.0, sample_docs / max(n, 1))
        pick = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)
        sample = keep(
            labelled.filter(pick).select("doc_id", (F.col("toxic") > 0).alias("toxic"), text_bytes(F.col("text")).alias("text"))
        )

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, "text"):
                ids, toxic, words = [], [], []
                for doc, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text"))):
                    found = {letters(w)[1:-1] for w in units(text)} - {""}
                    ids += [doc] * len(found)
                    toxic += [label] * len(found)
                    words += sorted(found)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "toxic": pa.array(toxic, pa.bool_()), "word": words})

        totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
        if not n_toxic or not n_clean:
            return cls(np.zeros(1 << BITS, np.float32), FLOOR)
        words = keep(sample.mapInArrow(split, "doc_id long, toxic boolean, word string"))
        counted = words.groupBy("word").agg(
            F.count_if("toxic").alias("toxic_docs"), F.count_if(~F.col("toxic")).alias("clean_docs")
        )
        least = max(2, round(0.003 * n_toxic))
        telling = counted.filter(
            (F.col("toxic_docs") >= least) & (F.col("toxic_docs") / n_toxic > 12 * F.col("clean_docs") / n_clean)
        )
        rows: dict[int, set[str]] = {}
        for r in words.filter("toxic").join(telling, "word").select("doc_id", "word").collect():
            rows.setdefault(r["doc_id"], set()).add(r["word"])
        positives = _cover(rows, least, max(4, round(0.01 * n_toxic)))
        if not positives:
            return cls(np.zeros(1 << BITS, np.float32), FLOOR)
        likeness = cls._likeness(positives)
        clean = counted.filter(F.col("toxic_docs") / n_toxic < 3 * F.col("clean_docs") / n_clean).select("word", "clean_docs")
        near = _scored(clean, likeness).orderBy(F.desc("margin"), "word").limit(NEGATIVES // 2)
        others = clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES // 2)
        negatives = {r["word"]: r["clean_docs"] for r in near.drop("margin").union(others).distinct().orderBy("word").collect()}
        model = cls._train(positives, negatives)
        scored = model.score(sample, keep_cols=("doc_id", "toxic")).select("toxic", "margins").toArrow()
        tops = scored.column("margins").combine_chunks().flatten().to_numpy().reshape(-1, TOP)
        model._calibrate(tops, scored.column("toxic").to_numpy().astype(float))
        return model

    @classmethod
    def _likeness(cls, positives: list[str]) -> ToxicWords:
        """How near a word is to the positives on the whole; used to find hard negatives."""
        cells, weights = subsequences([f"\x01{w}\x02"[:WIDTH] for w in positives])
        theta = np.zeros(1 << BITS, np.float32)
        np.add.at(theta, cells.ravel(), weights.ravel())
        return cls(np.minimum(theta, 3.0), 0.0)

    @classmethod
    def _train(cls, positives: list[str], negatives: dict[str, int]) -> ToxicWords:
        """Fit the machine on words; a mistake on a clean word costs more the more documents have it."""
        n_found = len(positives)
        positives = [*positives, *(v for w in positives for v in _altered(w))]
        words = [f"\x01{w}\x02"[:WIDTH] for w in [*positives, *negatives]]
        y = np.where(np.arange(len(words)) < len(positives), 1.0, -1.0)
        cells, weights = subsequences(words)
        half = LANDMARKS // 2
        rng = np.random.default_rng(0)
        chosen = np.concatenate(
            [
                np.arange(min(half, n_found)),
                len(positives) + rng.permutation(len(negatives))[: LANDMARKS - min(half, n_found)],
            ]
        ).astype(int)
        landmarks = cells[chosen], weights[chosen]
        values, vectors = np.linalg.eigh(kernel(*landmarks, *landmarks).astype(float))
        root = vectors / np.sqrt(np.maximum(values, 1e-6))[None, :] * (values > 1e-6)[None, :]
        z = kernel(cells, weights, *landmarks)
        del cells, weights
        root32 = root.astype(np.float32)
        for begin in range(0, len(z), 1024):  # in place: the driver holds one table of words by landmarks
            z[begin : begin + 1024] = z[begin : begin + 1024] @ root32
        seen = np.minimum(np.array([*[1] * len(positives), *negatives.values()]), 30)
        cost = COST * np.where(y > 0, max(1.0, 0.1 * len(negatives) / n_found), seen)
        cost[n_found : len(positives)] *= ALTERED_COST
        w = _machine(z, y, cost)
        theta, share = np.zeros(1 << BITS, np.float32), (root @ w[:-1]).astype(np.float32)
        for block, columns in _blocks(*landmarks):
            theta += columns @ share[block]
        return cls(theta, float(w[-1]))

    def _calibrate(self, tops: np.ndarray, labels: np.ndarray) -> None:
        """The logistic curve over a text's largest margins, by Newton steps with a light prior."""
        design = np.column_stack([tops, np.ones(len(tops))])
        w = self.curve
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (labels - p) - 1e-2 * w
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.curve = w

    def score(self, docs: DataFrame, text_col: str = "text", keep_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """The given columns, ``margins`` of the most toxic words, ``score`` (0 to 1) and ``predicted`` of each document.

        Whole texts are scored. Null and empty texts have no words and get the lowest score. Repeated
        rows give repeated results; an empty table gives none.
        """
        model = docs.sparkSession.sparkContext.broadcast(self)
        binary = dict(docs.dtypes)[text_col] == "binary"
        text = F.coalesce(F.col(text_col), F.lit(b"")) if binary else text_bytes(F.col(text_col))
        rows = docs.select(*[F.col(c) for c in keep_cols], text.alias("__text"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fitted, known = model.value, {}
            for batch in small_batches(batches, "__text"):
                tops = fitted.texts(batch.column("__text").to_pylist(), known)
                scores = fitted.chance(tops)
                ends = pa.array(np.arange(0, TOP * len(tops) + 1, TOP, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        pa.ListArray.from_arrays(ends, pa.array(tops.ravel())),
                        pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)),
                    ],
                    [*keep_cols, "margins", "score", "predicted"],
                )

        return rows.mapInArrow(run, f"{kinds}, margins array<double>, score double, predicted int")


def _scored(words: DataFrame, model: ToxicWords) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = shared.value.margins([w.encode() for w in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margins.astype(float))], [*batch.schema.names, "margin"])

    return words.mapInArrow(run, "word string, clean_docs long, margin double")


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> ToxicWords:
    """Learn from the labelled documents whose id falls in the training part."""
    rows = labels.filter(id_hash(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")
    return ToxicWords.fit(docs.select("doc_id", "text").join(rows, "doc_id"))


@query("op3_toxicity")
def op3_toxicity(spark, sf):
    docs = read(spark, sf, "documents")
    model = fit_on_labels(docs, read(spark, sf, "labels"))
    return model.score(docs).select(
        "doc_id", (id_hash(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )
