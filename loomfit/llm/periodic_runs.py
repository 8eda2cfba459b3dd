"""Periodic runs of words, found by string synchronising sets.

At scale t a set of positions is selected by the hashes of the t words that begin at each: a position
is in the set if the least hash of the t + 1 positions from it on is its own or that of the last one. Equal
contexts of 2 t words are selected alike, and unless a stretch repeats a few words, every t positions in a
row hold a selected one. A run of period p with t <= p < 2 t and of four periods at least thus has two
selected positions p words apart with equal contexts, and no equal context between them. So next
neighbours among equal contexts propose all periods of a scale. The scales are 8, 16, 32 and so on.

Stretches that repeat fewer than 8 words have few hashes and would fill the sets. They are found on
their own, by comparing each word with the ones 1 to 7 before it; they supply the periods below 8, and
positions inside them get no hash. Proposals are extended word by word, so hashes never decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, query, read, small_batches, text_bytes
from .common import _mixed as mixed

MIN_LENGTH = 6  # words of a run
MIN_PERIODS = 4  # the scales rely on four at least
FIRST_SCALE = 8  # smaller periods are found by comparing words directly
TEXT_BYTES = 512 * 1024  # text searched at once
NO_HASH = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where maximal stretches of True begin and end."""
    edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _is_smallest(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether the run has no smaller period; it holds two periods, so such a one would divide its period."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            smaller = period // factor
            if np.array_equal(words[start : end - smaller], words[start + smaller : end]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _extend(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around a position in which words ``period`` apart are identical.

    It is read in steps that double, so the work follows the stretch's length.
    """
    last = len(words) - period
    end, step = at, 64
    while end < last:
        stop = min(end + step, last)
        differ = np.flatnonzero(words[end:stop] != words[end + period : stop + period])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, 2 * step
    start, step = at, 64
    while start > 0:
        stop = max(start - step, 0)
        differ = np.flatnonzero(words[stop:start] != words[stop + period : start + period])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end + period


def _short_periods(words: np.ndarray) -> tuple[list[tuple[int, int, int]], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The runs with periods below FIRST_SCALE, and for each the stretches that repeat that many words."""
    found, regions = [], {}
    for period in range(1, min(FIRST_SCALE, len(words))):
        starts, ends = _stretches(words[period:] == words[:-period])
        long = ends - starts >= FIRST_SCALE - period
        regions[period] = starts[long], ends[long]
        long = ends - starts + period >= max(MIN_LENGTH, MIN_PERIODS * period)
        for start, end in zip(starts[long].tolist(), (ends[long] + period).tolist()):
            if _is_smallest(words, start, end, period):
                found.append((start, end, period))
    return found, regions


def synchronising_set(
    hashes: np.ndarray, scale: int, regions: dict[int, tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """The selected positions at a scale, ascending.

    ``hashes`` are those of the ``scale`` words from each position on. Positions whose words repeat up to
    a third of the scale, as far as ``regions`` has such stretches, are left out.
    """
    marks = np.zeros(len(hashes) + 1, np.int32)
    for period, (starts, ends) in regions.items():
        if 3 * period > scale:
            continue
        stops = np.minimum(ends - (scale - period) + 1, len(hashes))
        filled = stops > starts
        np.add.at(marks, starts[filled], 1)
        np.add.at(marks, stops[filled], -1)
    hashes = np.where(np.cumsum(marks[:-1]) > 0, NO_HASH, np.minimum(hashes, NO_HASH - np.uint64(1)))
    least, width = hashes, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(hashes) - scale
    least = np.minimum(least[:n], hashes[scale:])
    return np.flatnonzero((least != NO_HASH) & ((hashes[:n] == least) | (hashes[scale:] == least)))


def find_runs(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of some texts as (start, end, period), in no order.

    ``words`` are numbers, one text after another, the longest first, and each text is followed by a number
    that occurs once. ``ends`` has the place of that number for each text.
    """
    found, regions = _short_periods(words)
    sizes = np.diff(ends, prepend=-1) - 1
    hashes, scale = mixed(words.astype(np.uint64) * _ODD + _ODD), 1
    while True:
        texts = int(np.count_nonzero(sizes >= MIN_PERIODS * max(scale, FIRST_SCALE)))
        if not texts:
            return found
        # Longer texts come first, so those that matter from here on are the front part.
        n = int(ends[texts - 1]) + 1
        hashes = hashes[: n - scale + 1]
        double = mixed(hashes[:-scale] * _ODD + hashes[scale:])
        if scale >= FIRST_SCALE:
            selected = synchronising_set(hashes, scale, regions)
            selected = selected[selected < len(double)]
            contexts = double[selected]
            order = np.argsort(contexts, kind="stable")
            contexts, places = contexts[order], selected[order]
            periods = places[1:] - places[:-1]
            proposed = np.flatnonzero((contexts[1:] == contexts[:-1]) & (periods >= scale) & (periods < 2 * scale))
            places, periods = places[proposed], periods[proposed]
            order = np.lexsort((places, periods))
            last, until = 0, 0
            for place, period in zip(places[order].tolist(), periods[order].tolist()):
                if period == last and place + period < until:
                    continue
                start, end = _extend(words[:n], place, period)
                last, until = period, end
                if end - start >= MIN_PERIODS * period and _is_smallest(words, start, end, period):
                    found.append((start, end, period))
        hashes, scale = double, 2 * scale


def _search(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """For each text its runs as (start, length, period), ordered, and its words without repetitions."""
    split = [text.split() for text in texts]
    order = sorted(range(len(split)), key=lambda i: -len(split[i]))
    numbers: dict[bytes, int] = {}
    parts, fresh, unused = [], count(), count(-1, -1)
    for i in order:
        parts.append(np.fromiter(map(numbers.setdefault, split[i], fresh), np.int64, len(split[i])))
        parts.append(np.array([next(unused)], np.int64))
    ends = np.cumsum([len(split[i]) + 1 for i in order]) - 1
    words = np.concatenate(parts)
    runs = [[] for _ in texts]
    collapsed = [None] * len(texts)
    for start, end, period in sorted(find_runs(words, ends), key=lambda run: (run[0], run[2])):
        k = int(np.searchsorted(ends, start))
        runs[order[k]].append((start - (int(ends[k - 1]) + 1 if k else 0), end - start, period))
    for i, found in enumerate(runs):
        kept = split[i]
        if found:
            dropped = np.zeros(len(kept) + 1, np.int32)
            for start, length, period in found:
                dropped[start + period] += 1
                dropped[start + length] -= 1
            kept = [kept[j] for j in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
        collapsed[i] = b" ".join(kept)
    return runs, collapsed


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """Per document: doc_id, ``runs`` (start, length, period; ordered by start, then period) and ``collapsed``.

    A run is a stretch of consecutive words with smallest period q, of max(6, 4 q) words at least, that no
    neighbouring word extends. ``collapsed`` is the text, its words joined by one space, without the words
    that some run holds after its first q words. Words are parted by the ASCII blanks and compared as bytes.

    Whole texts are searched, some at a time, without a shuffle. Null and empty texts have no runs and
    collapse to an empty text. Repeated rows and null ids give a row each, an empty table none, and columns
    other than the id and the text are ignored, whatever their names.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXT_BYTES):
            if not batch.num_rows:
                continue
            runs, collapsed = _search(batch.column("text").to_pylist())
            flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type))
            offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(collapsed, pa.binary())],
                ["doc_id", "runs", "collapsed"],
            )

    text = F.col("text") if text is None else text
    rows = docs.select(F.col("doc_id"), text_bytes(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def report(found: DataFrame) -> DataFrame:
    """Numbers and digests of ``periodic_runs``: the count of runs, the one of most periods, and two SHA-256.

    Of runs with equally many periods (compared exactly) the one that starts first counts, then the one of the
    smallest period. Without runs its four columns are null.
    """
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda top, r: F.when(r.length * top.period > top.length * r.period, r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def planted(docs: DataFrame) -> Column:
    """The text, in every tenth document by the hash of its id with its end replaced by a repetition.

    With h the crc32 of the id and g = h / 10, word i >= a of n words becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) / (3 + g % 8). A null id keeps its text.
    """
    hashed = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce(docs["text"], F.lit("")), f"{SPACE}+"), lambda w: w != "")

    def repeated(parts: Column) -> Column:
        n = F.size(parts).cast("long")
        tenth = F.floor(hashed / 10)
        begin = tenth % n
        period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + tenth % 8))
        place = lambda i: F.when(i < begin, i).otherwise(begin + (i - begin) % period)
        return F.array_join(F.transform(parts, lambda _, i: F.get(parts, place(i.cast("long")).cast("int"))), " ")

    chosen = (hashed % 10 == 0) & docs["text"].rlike(r"[^\x20\x09-\x0D]")
    return F.when(chosen, F.aggregate(F.array(words), F.lit(""), lambda _, parts: repeated(parts))).otherwise(docs["text"])


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf):
    """Runs of all documents, with repetitions planted in every tenth."""
    docs = read(spark, sf, "documents")
    return report(periodic_runs(docs, planted(docs)))
