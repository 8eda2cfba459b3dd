"""Language model scoring by online logistic context mixing.

A text is scored bit by bit. Each of several contexts, hashed into a table of counts, predicts the next
bit; the predictions are added in the logistic domain with weights that are picked by a gate (the
place of the bit in its byte) and refined after every byte by how wrong the mix was.

The tables are counted over the whole training corpus. Beside the model's log probability each text gets
that of a word model with add-half smoothing, whose counts are exact and never leave the cluster whole:
every block of documents gets the counts of its own words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLDED, Spans, _mixed, id_hash, keep, query, read, small_batches, text_bytes

# Contexts: the last 2, 3 and 5 bytes, and the word so far. Their tables have 2**bits slots of 16
# counts, one per half byte; the sparser a context, the more slots.
SLOT_BITS = (15, 17, 19, 19)
COUNT_BYTES = 512 * 1024  # text counted at once
SCORE_BYTES = 1024 * 1024  # text scored at once
TASK_SPLITS = 8  # input splits that a counting task puts together, as it sends whole tables
CHUNK = 1 << 12  # slots that travel together
FAN_IN = 32  # partial tables that one task adds up
LANE = 1024  # bytes over which weights are refined before they start afresh
RATE = 0.02
FIRST_WEIGHT = 0.35
PRIOR = 0.4  # count given to either value of a bit
STEP = 15.0  # steps of a stored prediction per unit of log odds
CLIP = 9.2  # largest log odds of a bit, about 1 in 10,000
BLOCK_DOCS = 4096
PIECE = 1 << 14  # bytes of text whose contexts are hashed together
GROUP = 1 << 16  # bytes of text whose predictions are looked up together
END = b"\n"
END_WORD = 0  # stands for the end of a text among the hashes of words


class Bytes:
    """The texts of a batch as the model reads them: lower-cased words, a space after each, and an end.

    ``data`` has their bytes, ``bounds`` where each text begins, ``word_starts`` where each token
    begins (ends are tokens too), and ``offsets`` the first token of each text.
    """

    def __init__(self, spans: Spans):
        sizes = np.append(spans.ends - spans.starts, 0) + 1  # with the space that follows
        tokens = np.insert(np.arange(len(spans)), spans.offsets[1:], len(spans))  # an end after each text
        sizes = sizes[tokens]
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
        after = first + sizes - 1
        source = np.repeat(np.append(spans.starts, 0).astype(np.int32)[tokens], sizes) + place
        source[after] = 0
        data = spans.data[source] if len(spans.data) else np.zeros(len(source), np.uint8)
        data[(data >= 65) & (data <= 90)] += 32
        data[after] = np.where(tokens < len(spans), 32, END[0])
        self.data, self.place = data, place
        self.offsets = spans.offsets + np.arange(len(spans.offsets))
        self.bounds = np.append(first, len(data))[self.offsets]
        self.word_starts = first

    def contexts(self) -> np.ndarray:
        """A 64-bit hash per context and byte of what comes before the byte in its text."""
        n = len(self.data)
        out = np.empty((len(SLOT_BITS), n), np.uint64)
        before = np.concatenate([np.zeros(5, np.uint8), self.data])
        powers = np.cumprod(np.full(int(self.place.max(initial=0)) + 1, 0x2545F4914F6CDD1D, np.uint64))
        sums = np.zeros(n + 1, np.uint64)
        for piece in _pieces(n):
            size = piece.stop - piece.start
            codes = before[piece.start : piece.stop + 5].astype(np.uint64)
            codes += np.uint64(1)
            np.multiply(codes[5:], powers[self.place[piece]], out=sums[piece.start + 1 : piece.stop + 1])
            recent = codes[4 : 4 + size].copy()
            for k in range(2, 6):
                recent |= codes[5 - k : 5 - k + size] << np.uint64(9 * (k - 1))
                if k in (2, 3, 5):
                    out[(2, 3, 5).index(k), piece] = recent
        for k in range(5):  # a text's first bytes have fewer before them
            at = self.bounds[:-1] + k
            out[:3, at[at < self.bounds[1:]]] &= np.uint64((1 << 9 * k) - 1)
        np.cumsum(sums, out=sums)
        for piece in _pieces(n):
            np.subtract(sums[piece], sums[np.arange(piece.start, piece.stop) - self.place[piece]], out=out[3, piece])
            for k in range(len(SLOT_BITS)):
                out[k, piece] += np.uint64((k + 1) << 56)
                out[k, piece] = _mixed(out[k, piece])
        return out


def _pieces(n: int) -> list[slice]:
    return [slice(begin, min(begin + PIECE, n)) for begin in range(0, n, PIECE)]


def slots(contexts: np.ndarray, high: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the first and of the second half of a byte; the second knows the first."""
    shift = np.uint64(64 - bits)
    second = (contexts ^ (high + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return (contexts >> shift).view(np.int64), (second >> shift).view(np.int64)


def _predictions(counts: np.ndarray) -> np.ndarray:
    """Stored log odds of each node of each slot, from the counts of its 16 half bytes."""
    out = np.zeros((len(counts), 16), np.int8)
    sums = counts.astype(np.float32)
    for depth in (3, 2, 1, 0):
        pairs = sums.reshape(len(counts), -1, 2)
        odds = np.log((pairs[:, :, 1] + PRIOR) / (pairs[:, :, 0] + PRIOR))
        out[:, 1 << depth : 2 << depth] = np.clip(np.rint(odds * STEP), -127, 127)
        sums = pairs.sum(axis=2)
    return out


def _packed(counts: np.ndarray) -> bytes:
    filled = np.flatnonzero(counts)
    raw = len(filled).to_bytes(4, "little") + filled.astype("<u2").tobytes() + counts[filled].astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _add(counts: np.ndarray, packed: bytes) -> None:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    counts[np.frombuffer(raw, "<u2", n, 4)] += np.frombuffer(raw, "<i8", n, 4 + 2 * n)


@dataclass
class ContextMixer:
    """Fitted tables: for each context the log odds of each node of each slot."""

    tables: list[np.ndarray] = field(repr=False)

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text") -> ContextMixer:
        """Count the half bytes that follow each context over all given texts.

        Tasks send their tables in packed pieces, which are added up FAN_IN at a time. The driver gets the
        final tables, whose size is fixed by SLOT_BITS.
        """

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros(16 << bits, np.int32) for bits in SLOT_BITS]
            for batch in small_batches(batches, "text", COUNT_BYTES):
                text = Bytes(Spans(batch.column("text")))
                contexts = text.contexts()
                for piece in _pieces(len(text.data)):
                    data = text.data[piece]
                    high, low = (data >> 4).astype(np.int64), (data & 15).astype(np.int64)
                    for total, context, bits in zip(totals, contexts[:, piece], SLOT_BITS):
                        first, second = slots(context, high.view(np.uint64), bits)
                        np.add.at(total, (first << 4) + high, np.int32(1))
                        np.add.at(total, (second << 4) + low, np.int32(1))
            part = TaskContext.get().partitionId()
            for k, total in enumerate(totals):
                packed = [(i, _packed(piece)) for i, piece in enumerate(total.reshape(-1, 16 * CHUNK)) if piece.any()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * len(packed), pa.int32()),
                        "context": pa.array([k] * len(packed), pa.int32()),
                        "chunk": pa.array([i for i, _ in packed], pa.int32()),
                        "counts": pa.array([p for _, p in packed], pa.binary()),
                    }
                )

        def add(key, group):
            total = np.zeros(16 * CHUNK, np.int64)
            for packed in group.column("counts").to_pylist():
                _add(total, packed)
            part, context, chunk = (k.as_py() for k in key)
            return pa.table(
                {
                    "part": pa.array([part], pa.int32()),
                    "context": pa.array([context], pa.int32()),
                    "chunk": pa.array([chunk], pa.int32()),
                    "counts": pa.array([_packed(total)], pa.binary()),
                }
            )

        schema = "part int, context int, chunk int, counts binary"
        texts = docs.select(text_bytes(F.col(text_col)).alias("text"))
        n_tasks = max(docs.sparkSession.sparkContext.defaultParallelism, texts.rdd.getNumPartitions() // TASK_SPLITS)
        sums = keep(texts.coalesce(n_tasks).mapInArrow(count, schema))
        while (sums.agg(F.max("part")).first()[0] or 0) > 0:
            sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
            sums = keep(sums.groupBy("part", "context", "chunk").applyInArrow(add, schema))
        tables = [np.zeros((1 << bits, 16), np.int8) for bits in SLOT_BITS]
        for row in sums.coalesce(8).toLocalIterator():  # a job per part
            piece = np.zeros(16 * CHUNK, np.int64)
            _add(piece, row["counts"])
            tables[row["context"]][row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = _predictions(piece.reshape(-1, 16))
        return cls([table.ravel() for table in tables])

    def log10(self, text: Bytes) -> np.ndarray:
        """log10 of the probability of each token of a batch, given what comes before it in its text.

        Texts are cut into lanes that are read side by side, one byte of each at a time. A lane knows what
        comes before it in its text, and starts with the first weights.
        """
        sizes = np.diff(text.bounds)
        per_text = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(sizes)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = text.bounds[owner] + nth * LANE
        lengths = np.minimum(sizes[owner] - nth * LANE, LANE)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, (lengths[0] if len(lengths) else 0) + 1))
        contexts = text.contexts()
        # Weights are kept as -weight / STEP, so that stored steps need no scaling and their sum is the negative mix.
        # Those of the eight bits of a lane lie side by side, so a step works on long rows of numbers.
        # Errors are kept times the rate.
        weights = np.full((len(SLOT_BITS), 8 * len(lengths)), -FIRST_WEIGHT / STEP, np.float32)
        pushes = np.empty_like(weights)
        rate, clip = np.float32(-RATE / STEP**2), np.float32(CLIP)
        scores = np.zeros(len(text.data))
        group = max(1, GROUP // max(1, len(lengths)))  # steps whose predictions are looked up together
        for begin in range(0, len(active), group):
            steps = active[begin : begin + group]
            at = np.concatenate([starts[:a] + begin + t for t, a in enumerate(steps)])
            odds, bits = self._look_up(contexts.take(at, axis=1), text.data[at])
            odds, errors = odds.swapaxes(1, 2).reshape(len(SLOT_BITS), -1), bits.T.ravel() * rate
            done = 0
            for a in (8 * steps).tolist():
                x, used = pushes[:, :a], weights[:, :a]
                x[:] = odds[:, done : done + a]
                mixed = np.einsum("cl,cl->l", used, x)
                mixed.clip(-clip, clip, out=mixed)
                np.exp(mixed, out=mixed)
                mixed += 1
                error = errors[done : done + a]
                error -= np.divide(rate, mixed, out=mixed)
                x *= error
                used += x
                done += a
            errors /= rate
            chances = np.subtract(1, np.abs(errors, out=errors), out=errors)
            for _ in range(3):
                chances = chances[::2] * chances[1::2]
            scores[at] = np.log(chances)
        return np.add.reduceat(scores, text.word_starts) / np.log(10) if len(scores) else scores

    @cached_property
    def paths(self) -> list[np.ndarray]:
        """For each context, slot and half byte the log odds of the four nodes on the way to it, as one number."""
        nodes = [(1 << depth) + (value >> (4 - depth)) for value in range(16) for depth in range(4)]
        return [table.reshape(-1, 16).take(nodes, axis=1).view(np.uint32).ravel() for table in self.tables]

    def _look_up(self, contexts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stored log odds by context, bit and byte, and the bits; in memory, the bits of a byte lie side by side."""
        halves = np.stack([data >> 4, data & 15], axis=1).astype(np.int64)
        high = halves[:, 0].astype(np.uint64)
        odds = np.empty((len(contexts), 2 * len(data)), np.uint32)
        at = np.empty(halves.shape, np.int64)
        for k, (context, path) in enumerate(zip(contexts, self.paths)):
            at[:, 0], at[:, 1] = slots(context, high, SLOT_BITS[k])
            at <<= 4
            at += halves
            path.take(at.ravel(), out=odds[k], mode="clip")
        odds = odds.view(np.int8).reshape(len(contexts), len(data), 8)
        return odds.swapaxes(1, 2), np.unpackbits(data).reshape(-1, 8).T


def _blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text and block: some thousand rows that follow each other in a partition.

    The block is a function of a row's place in the input, so reading the same input again gives the same blocks.
    """
    row = F.monotonically_increasing_id()
    return docs.select(
        "doc_id", text_bytes(F.col("text")).alias("text"), F.shiftrightunsigned(row, 12).alias("block")
    )


def _block_words(blocks: DataFrame, training) -> DataFrame:
    """block, word, n: each block's distinct words and how often its training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(block: int, words: list[np.ndarray], trains: list[np.ndarray]) -> pa.RecordBatch:
            found = pa.array(np.concatenate(words).view(np.int64)).dictionary_encode()
            distinct, place = found.dictionary, found.indices.to_numpy()
            n = np.bincount(place, weights=np.concatenate(trains), minlength=len(distinct)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(distinct), block, np.int64)), distinct, pa.array(n)],
                ["block", "word", "n"],
            )

        now, words, trains = None, [], []
        for batch in small_batches(batches, "text"):
            of = batch.column("block").to_numpy()
            for block in np.unique(of):
                part = batch.slice(int(np.searchsorted(of, block)), int((of == block).sum()))
                spans = Spans(part.column("text"))
                train = part.column("train").to_numpy(zero_copy_only=False).astype(float)
                if block != now and words:
                    yield counted(now, words, trains)
                    words, trains = [], []
                now = block
                words += [spans.hashes(FOLDED), np.full(part.num_rows, END_WORD, np.uint64)]
                trains += [np.repeat(train, np.diff(spans.offsets)), train]
                if sum(map(len, words)) > 2_000_000:
                    yield counted(now, words, trains)
                    words, trains = [], []
        if words:
            yield counted(now, words, trains)

    found = blocks.select("block", "text", training.alias("train")).mapInArrow(run, "block long, word long, n long")
    return found


def score(docs: DataFrame, training) -> DataFrame:
    """Score all texts by a model of the rows for which ``training`` is true.

    Columns: doc_id, n_tokens (words and one end), n_known (of them, those the training texts have),
    train_tokens, n_bytes (what the mixer reads), base_score and score (log10 probabilities).
    Null and empty texts are an end alone. Repeated rows give repeated results; an empty table
    gives none; other columns are ignored. Without training rows every token is unknown.
    """
    docs = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(ContextMixer.fit(docs.filter(training)))
    words = keep(_block_words(_blocks(docs), training))
    counts = words.groupBy("word").agg(F.sum("n").alias("c"))
    total, distinct = counts.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known = words.select("block", "word").join(counts, "word")
    kind = docs.schema["doc_id"].dataType.simpleString()
    divisor = np.log10(max(total + 0.5 * (distinct + 1), 0.5))

    def run(key, texts, found):
        hashes = found.column("word").combine_chunks()
        count = found.column("c").to_numpy()
        cost, seen = np.log10(count + 0.5) - divisor, count > 0
        end = pc.index(hashes, END_WORD).as_py()
        out = []
        for batch in small_batches(texts.combine_chunks().to_batches(), "text", SCORE_BYTES):
            spans = Spans(batch.column("text"))
            places = pc.index_in(pa.array(spans.hashes(FOLDED).view(np.int64)), value_set=hashes)
            if places.null_count or end < 0:
                raise ValueError("the input gave other rows when it was read again")
            at = places.to_numpy()
            sums = np.concatenate([[0.0], np.cumsum(cost[at])])[spans.offsets]
            hits = np.concatenate([[0], np.cumsum(seen[at])])[spans.offsets]
            text = Bytes(spans)
            logs = np.concatenate([[0.0], np.cumsum(model.value.log10(text))])[text.offsets]
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_tokens": pa.array(np.diff(text.offsets)),
                        "n_known": pa.array(np.diff(hits) + int(seen[end])),
                        "n_bytes": pa.array(np.diff(text.bounds)),
                        "base_score": pa.array(np.diff(sums) + cost[end]),
                        "score": pa.array(np.diff(logs)),
                    }
                )
            )
        return pa.concat_tables(out)

    schema = f"doc_id {kind}, n_tokens long, n_known long, n_bytes long, base_score double, score double"
    scored = _blocks(docs).groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))


@query("op6_lm_scoring")
def op6_lm_scoring(spark, sf):
    held = id_hash(F.col("doc_id"), 5) == 1
    scored = score(read(spark, sf, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")
