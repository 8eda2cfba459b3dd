"""Language identification by error-correcting output codes.

Every language has a codeword of bits. A binary n-gram classifier per bit tells the languages that
have it from those that have not; a text's bit margins are decoded to the codeword with the least
weighted loss. A near tie between two codewords is flagged as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_hash, query, read, small_batches, text_bytes

UNKNOWN = "und"
ORDERS = (3, 4)  # bytes per n-gram
BITS = 15  # n-grams are hashed into 2**BITS cells
PIECE = 1 << 18  # bytes whose n-grams are looked up at once
EXHAUSTIVE = 6  # languages up to which every useful bit is in the code
SMOOTHING = 0.5
SHARPNESS = 2.0
MARGIN = 0.05  # losses nearer than this share of the largest possible gap are ambiguous


def code_matrix(n: int, seed: int = 0) -> np.ndarray:
    """Codewords of +1 and -1, one row per language, no two columns equal or opposite."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE:
        columns = np.arange(1 << (n - 1), (1 << n) - 1)  # the first language always has the bit
        return np.array([[1 if c >> (n - 1 - row) & 1 else -1 for c in columns] for row in range(n)], dtype=np.int8)
    rng = np.random.default_rng(seed)
    best, distance = None, -1
    for _ in range(200):
        code = np.where(rng.random((n, 10 * math.ceil(math.log2(n)))) < 0.5, -1, 1).astype(np.int8)
        balanced = np.abs(code.sum(axis=0)) < n
        gram = code[:, balanced].astype(int) @ code[:, balanced].T.astype(int)
        nearest = int((balanced.sum() - gram[~np.eye(n, dtype=bool)]).min())
        if nearest > distance:
            best, distance = code[:, balanced], nearest
    return best


def ngram_cells(data: np.ndarray, order: int) -> np.ndarray:
    """The cell of the n-gram that begins at each byte; ``order - 1`` fewer than bytes."""
    n = len(data) - order + 1
    cells = np.full(max(n, 0), order, dtype=np.uint32)
    for k in range(order):
        cells = (cells + data[k : k + len(cells)]) * np.uint32(2654435761)
        cells ^= cells >> np.uint32(15)
    return (cells >> np.uint32(32 - BITS)).astype(np.int64)


PAD = max(ORDERS) - 1


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each between spaces and followed by zeros; their starts; which bytes are no zeros.

    Only n-grams that begin in a text count, and the zeros keep those from reaching into the next.
    """
    parts = [b" " + t.lower() + b" " + b"\0" * PAD for t in texts]
    starts = np.cumsum([0, *map(len, parts)])
    own = np.ones(starts[-1], bool)
    for k in range(PAD):
        own[starts[1:] - 1 - k] = False
    return np.frombuffer(b"".join(parts), dtype=np.uint8), starts, own


@dataclass
class LanguageCodes:
    """A fitted model: the languages, their codewords, and per bit a weight per n-gram cell."""

    languages: list[str]
    code: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)  # cells x bits
    bit_weights: np.ndarray = field(repr=False)

    @classmethod
    def fit(cls, docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageCodes:
        """Learn from all rows with a language. N-grams are counted per language on the cluster; the driver
        gets one count per language and cell. Null and empty texts add nothing.
        """

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[str, np.ndarray] = {}
            for batch in batches:
                for part in small_batches([batch], "text"):
                    by_lang: dict[str, list[bytes]] = {}
                    for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                        by_lang.setdefault(lang, []).append(text)
                    for lang, texts in by_lang.items():
                        total = totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
                        data, _, own = _joined(texts)
                        for begin in range(0, len(data), PIECE):
                            for order in ORDERS:
                                piece = data[begin : begin + PIECE + order - 1]
                                cells = ngram_cells(piece, order)
                                total += np.bincount(cells[own[begin : begin + len(cells)]], minlength=1 << BITS)
            for lang, total in totals.items():
                cells = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cells)), pa.array(cells.astype(np.int32)), pa.array(total[cells])],
                    ["lang", "cell", "n"],
                )

        rows = docs.filter(F.col(lang_col).isNotNull()).select(
            F.col(lang_col).alias("lang"), text_bytes(F.col(text_col)).alias("text")
        )
        counted = (
            rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
        )
        names = np.array(counted.column("lang").to_pylist(), dtype=object)
        languages = sorted(set(names))
        counts = np.zeros((len(languages), 1 << BITS))
        if languages:
            place = {name: i for i, name in enumerate(languages)}
            counts[[place[name] for name in names], counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
        return cls._from_counts(languages, counts)

    @classmethod
    def _from_counts(cls, languages: list[str], counts: np.ndarray) -> LanguageCodes:
        code = code_matrix(len(languages))
        p = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True) if len(languages) else counts
        weights, bit_weights = [], []
        for bit in code.T:
            yes, no = p[bit > 0].mean(axis=0), p[bit < 0].mean(axis=0)
            ratio = np.log(yes / no)
            weights.append(ratio)
            bit_weights.append(((yes - no) * ratio).sum())  # how far apart the sides are
        total = sum(bit_weights) or 1.0
        return cls(
            languages,
            code.astype(np.float32),
            np.array(weights, dtype=np.float32).T.reshape(1 << BITS, -1).copy(),
            np.array(bit_weights, dtype=np.float32) / total,
        )

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """The mean n-gram weight of each text for each bit."""
        data, starts, own = _joined(texts)
        sums = np.zeros((len(texts), self.weights.shape[1]))
        for begin in range(0, len(data), PIECE):
            first = np.searchsorted(starts, begin, side="right") - 1
            for order in ORDERS:
                cells = ngram_cells(data[begin : begin + PIECE + order - 1], order)
                if len(cells):
                    cuts = np.maximum(starts[first:-1] - begin, 0)
                    cuts = cuts[cuts < len(cells)]
                    values = self.weights[cells]
                    values[~own[begin : begin + len(cells)]] = 0
                    sums[first : first + len(cuts)] += np.add.reduceat(values, cuts, axis=0)
        return sums / (len(ORDERS) * (np.diff(starts) - PAD))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language with the least weighted loss, a score, and whether the second is near."""
        agreement = np.clip(SHARPNESS * margins[:, None, :] * self.code[None], -8, 8)
        losses = (np.exp(-agreement) * self.bit_weights).sum(axis=2)
        best = losses.argmin(axis=1)
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / shares.sum(axis=1)
        second = np.sort(losses, axis=1)[:, 1] if losses.shape[1] > 1 else np.full(len(losses), np.inf)
        return best, score, second - losses.min(axis=1) < MARGIN

    def predict(
        self, docs: DataFrame, text_col: str = "text", keep_cols: tuple[str, ...] = ("doc_id",)
    ) -> DataFrame:
        """One row per document: the given columns, lang_pred, score (0 to 1), ambiguous.

        A text that is null or has no letter is ``und`` with score 0, as is every text if no language
        was learned. Ties go to the first language in alphabetical order. Repeated rows give repeated
        results, an empty table gives none, other columns are ignored.
        """
        model = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fitted = model.value
            names = np.array([*fitted.languages, UNKNOWN], dtype=object)
            for batch in small_batches(batches, "__text"):
                known = batch.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
                if fitted.languages:
                    best, score, near = fitted.decode(fitted.margins(batch.column("__text").to_pylist()))
                else:
                    known, best = np.zeros(len(known), bool), np.zeros(len(known), int)
                    score, near = np.zeros(len(known)), np.zeros(len(known), bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-2],
                        pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array(near | ~known),
                    ],
                    [*keep_cols, "lang_pred", "score", "ambiguous"],
                )

        rows = docs.select(
            *[F.col(c) for c in keep_cols],
            text_bytes(F.col(text_col)).alias("__text"),
            F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters"),
        )
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
        return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")


@query("op4_language_id")
def op4_language_id(spark, sf):
    docs = read(spark, sf, "documents")
    part = id_hash(F.col("doc_id"), 4)
    model = LanguageCodes.fit(docs.filter(part != 2))
    return model.predict(docs).select("doc_id", (part == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
