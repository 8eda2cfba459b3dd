"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question asked again with other values has the
same template. Windows of the template are hash-joined with those of the benchmark, and an aligned
match is kept only if equal slots of the item hold equal values in the document. Windows that are mostly
placeholders are joined with their values. All is done in two readings: a capital that begins a sentence
is a word in the first and a name in the second.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FOLDED, Spans, keep, query, read, small_batches, text_bytes

WIDTH = 8  # tokens of a window
LITERALS = 0.6  # share of a window that must be words, not placeholders, or else its values count
READINGS = (False, True)  # whether a capital that begins a sentence is a name
FILTER_BITS = 22  # the prefilter has 2**FILTER_BITS cells, whatever the size of the benchmark
TEXT_BYTES = 256 * 1024  # text read at once
COVERAGE = 0.5  # share of an item's windows, or of its tokens along one alignment, that a document must have
RUN = 13  # or so many of its tokens in a row
CONSISTENCY = 0.8  # share of an item's slots that must hold one value

WORD, NUMBER, UNIT, NAME, NOTHING = range(5)
UNITS = (
    b"mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons "
    b"lb lbs pound pounds ounce ounces ml l liter liters litre litres gallon gallons second seconds minute "
    b"minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    b"percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh"
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PLACEHOLDERS = np.array([0, 0x51AFD7ED558CCD11, 0x64C4CEB9FE1A85EC, 0x7F4A7C159E3779B9, 0], np.uint64)


def _among(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_PUNCTUATION = _among(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_DIGIT, _IN_NUMBER, _UPPER = _among(b"0123456789"), _among(b"0123456789.,:/"), _among(bytes(range(65, 91)))
_END, _QUOTE = _among(b".!?:;|"), _among(b"\"')]")
_UNIT_HASHES = np.sort(Spans(pa.array([UNITS], pa.binary())).hashes(FOLDED))


def _without_accented_capitals(data: np.ndarray) -> np.ndarray:
    """The Latin-1 letters above ASCII, two bytes each in UTF-8, in lower case."""
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    capital = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return np.where(capital, data + np.uint8(0x20), data)


_MEASURE = re.compile(rb"([0-9][0-9.,:/]*)(" + b"|".join(sorted(UNITS.split(), key=len, reverse=True)) + rb")", re.IGNORECASE)


class Templates:
    """The canonical tokens of a batch of texts.

    Words count in lower case (Latin-1) without ASCII punctuation around them. Numbers, units and names
    (a capital that begins no sentence or line; with ``first_names`` those too) become placeholders, a
    number with its unit two, names in a row one; what is only punctuation is left out. ``offsets`` has
    the first token of each text, ``values`` the hashes of the tokens themselves.
    """

    def __init__(self, texts: pa.Array, first_names: bool = False):
        spans = self.spans = Spans(texts)
        spans.data = _without_accented_capitals(spans.data)
        data = spans.data
        solid = np.flatnonzero(~_PUNCTUATION[data])
        low, high = np.searchsorted(solid, spans.starts), np.searchsorted(solid, spans.ends)
        whole = np.append(solid, 0)
        some = high > low
        starts = np.where(some, whole[low], spans.starts)
        ends = np.where(some, whole[high - 1] + 1, spans.starts)
        foreign = np.concatenate([np.zeros(1, np.int32), np.cumsum(~_IN_NUMBER[data], dtype=np.int32)])
        raw_starts, raw_ends, offsets = spans.starts, spans.ends, spans.offsets
        first = data[np.minimum(starts, len(data) - 1)] if len(spans) else np.zeros(0, np.uint8)
        cuts = {}
        for i in np.flatnonzero(some & _DIGIT[first] & (foreign[ends] > foreign[starts])).tolist():
            parts = _MEASURE.fullmatch(data[starts[i] : ends[i]].tobytes())
            if parts:
                cuts[i] = int(starts[i]) + len(parts[1])
        if cuts:
            at, cut = np.array(list(cuts)), np.array(list(cuts.values()))
            starts, raw_starts = np.insert(starts, at + 1, cut), np.insert(raw_starts, at + 1, cut)
            ends, raw_ends = np.insert(ends, at, cut), np.insert(raw_ends, at, cut)
            some = np.insert(some, at, True)
            offsets = offsets + np.searchsorted(at, offsets)
        n = len(starts)
        hashes = spans.hashes(FOLDED, starts, ends)
        first = data[np.minimum(starts, len(data) - 1)] if n else np.zeros(0, np.uint8)
        upper = np.concatenate([np.zeros(1, np.int32), np.cumsum(_UPPER[data], dtype=np.int32)])
        types = np.full(n, WORD, np.int8)
        types[_UPPER[first] & (upper[ends] - upper[starts] == 1)] = NAME
        types[_UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, hashes), len(_UNIT_HASHES) - 1)] == hashes] = UNIT
        types[_DIGIT[first] & (foreign[ends] == foreign[starts])] = NUMBER
        types[~some] = NOTHING
        last = data[raw_ends - 1]
        before = data[np.maximum(raw_ends - 2, 0)] if n else last
        stops = _END[last] | _QUOTE[last] & _END[before]
        line = np.searchsorted(np.flatnonzero(data == 10), raw_starts)
        begins = np.ones(n, bool)
        begins[1:] = stops[:-1] | (line[1:] > line[:-1])
        begins[offsets[:-1][offsets[:-1] < n]] = True
        name = types == NAME
        if not first_names:
            types[name & begins] = WORD
        joined = np.zeros(n, bool)  # a name right after a name
        apart = begins[1:] | (ends[:-1] < raw_ends[:-1]) | (starts[1:] > raw_starts[1:])
        joined[1:] = (types[1:] == NAME) & (types[:-1] == NAME) & ~apart
        kept = np.flatnonzero((types != NOTHING) & ~joined)
        self.offsets = np.searchsorted(kept, offsets)
        self.types, self.first = types[kept], (name & begins)[kept]
        # a run of names ends where the next token that is no part of it begins
        after = np.flatnonzero(~np.append(joined, False))
        final = after[np.searchsorted(after, kept, side="right")] - 1 if n else kept
        self.starts, self.ends = starts[kept], ends[final]
        summed = np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])
        self.values = summed[final + 1] - summed[kept]
        slot = self.types != WORD
        self.hashes = np.where(slot, _PLACEHOLDERS[self.types], self.values)
        self.half = np.where(self.types == NAME, _PLACEHOLDERS[NAME], self.values) if first_names else self.values

    def value(self, i: int) -> bytes | None:
        """What a placeholder stands for; None for a word."""
        if self.types[i] == WORD:
            return None
        return b" ".join(self.spans.data[self.starts[i] : self.ends[i]].tobytes().lower().split())

    def windows(self, width: int, vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of the windows inside a text, without words that the vocabulary lacks, and their hashes.

        Windows with too few words are hashed with the values of their placeholders; if names that begin
        sentences count as names, then names stay placeholders there and the other values must be enough.
        """
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def count(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[width:] - total[:n]

        word = self.types == WORD
        literal = self.half != _PLACEHOLDERS[NAME]
        wordy = count(word) >= LITERALS * width
        valued = ~wordy & (count(literal) >= LITERALS * width)
        if vocabulary is not None:
            strange = ~_holds(vocabulary, self.values)
            wordy &= count(word & strange) == 0
            valued &= count(literal & strange) == 0
        found = []
        for flags, tokens, seed in ((wordy, self.hashes, 0), (valued, self.half, 1)):
            at = np.flatnonzero(flags)
            text = np.searchsorted(self.offsets, at, side="right")
            at = at[at + width <= self.offsets[text]]
            out = np.full(len(at), width + (seed << 8), np.uint64)
            for k in range(width):
                out = (out ^ tokens[at + k]) * _MULTIPLIER
                out ^= out >> np.uint64(29)
            found.append((at, out))
        at, out = (np.concatenate(f) for f in zip(*found))
        order = np.argsort(at)
        return at[order], out[order]


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _holds(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the cell of each hash is set, in a filter of eight cells a byte."""
    cell = _cell(hashes)
    return (packed[cell >> 3] << (cell & 7).astype(np.uint8)) & 128 > 0


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.astype(np.uint64).view(np.int64))


def item_windows(items: DataFrame) -> DataFrame:
    """The distinct windows of each template class of (item_id, text), in both readings.

    Items with the same windows and the same pattern of equal slots are one class, named by its smallest
    id, of any type that has an order; items without an id are left out. An item shorter than a window is one window. Columns: reading, hash, width, item_id, n_items, at,
    n_windows, n_tokens (in the windows), slots (for each placeholder of the window its offset, the number of
    its value, and whether the value is found elsewhere than at the beginning of sentences).
    """
    kind = items.schema["item_id"].dataType.simpleString()
    schema = (
        f"item_id {kind}, class long, reading int, hash long, width int, at int, n_windows int, n_tokens int, "
        "slots array<struct<at:int,slot:int,sure:boolean>>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for reading in READINGS:
                rows += _item_rows(batch, reading)
            fields = _ITEM_SCHEMA.set(0, pa.field("item_id", batch.schema.field("item_id").type))
            columns = list(zip(*rows)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    found = items.filter(F.col("item_id").isNotNull()).select(
        "item_id", text_bytes(F.col("text")).alias("text")
    ).mapInArrow(run, schema)
    return found.groupBy("class", "reading", "hash").agg(
        F.min("item_id").alias("item_id"),
        F.count_distinct("item_id").alias("n_items"),
        *[F.first(c).alias(c) for c in ("width", "at", "n_windows", "n_tokens", "slots")],
    ).drop("class")


def _item_rows(batch: pa.RecordBatch, reading: bool) -> Iterator[tuple]:
    templates = Templates(batch.column("text"), reading)
    by_width = {w: templates.windows(w) for w in {*np.minimum(np.diff(templates.offsets), WIDTH).tolist()} if w}
    for item, begin, end in zip(batch.column("item_id").to_pylist(), templates.offsets[:-1].tolist(), templates.offsets[1:].tolist()):
        if begin == end:
            continue
        width = min(WIDTH, end - begin)
        numbers: dict[tuple[int, bytes], int] = {}
        slots = [
            (i - begin, numbers.setdefault((int(templates.types[i]), templates.value(i)), len(numbers)))
            for i in range(begin, end)
            if templates.types[i] != WORD
        ]
        sure = {n for i, n in slots if not templates.first[begin + i]}
        places, hashes = by_width[width]
        first: dict[int, int] = {}
        for k in range(*np.searchsorted(places, [begin, end])):
            first.setdefault(int(hashes[k]), int(places[k]) - begin)
        pattern = xxhash.xxh3_64_intdigest(templates.hashes[begin:end].tobytes() + repr((slots, [*first])).encode()) >> 1
        n_tokens = len({at + k for at in first.values() for k in range(width)})
        for value, at in first.items():
            inside = [{"at": i - at, "slot": n, "sure": n in sure} for i, n in slots if at <= i < at + width]
            signed = int(np.uint64(value).view(np.int64))
            yield item, pattern, int(reading), signed, width, at, len(first), n_tokens, inside


_ITEM_SCHEMA = pa.schema(
    [
        ("item_id", pa.int64()), ("class", pa.int64()), ("reading", pa.int32()), ("hash", pa.int64()),
        ("width", pa.int32()), ("at", pa.int32()), ("n_windows", pa.int32()), ("n_tokens", pa.int32()),
        ("slots", pa.list_(pa.struct([("at", pa.int32()), ("slot", pa.int32()), ("sure", pa.bool_())]))),
    ]
)


def item_words(items: DataFrame) -> DataFrame:
    """The cells of the words and values of (item_id, text), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXT_BYTES):
            values = [Templates(batch.column("text"), reading).values for reading in READINGS]
            cells = np.unique(_cell(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32())], ["cell"])

    return items.select(text_bytes(F.col("text")).alias("text")).mapInArrow(run, "cell int").distinct()


def _cells(found: DataFrame) -> np.ndarray:
    """A flag per cell; at most 2**FILTER_BITS rows come to the driver."""
    cells = np.zeros(1 << FILTER_BITS, np.uint8)
    cells[found.toArrow().column("cell").to_numpy()] = 1
    return cells


def document_windows(docs: DataFrame, cells: np.ndarray, words: np.ndarray, widths: list[int]) -> DataFrame:
    """The windows of (doc_id, text) that pass the prefilter: doc_id, reading, hash, width, at, and the words they stand for."""
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(cells), np.packbits(words), widths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, vocabulary, sizes = shared.value
        for batch in small_batches(batches, "text", TEXT_BYTES):
            for reading in READINGS:
                templates = Templates(batch.column("text"), reading)
                for width in sizes:
                    at, found = templates.windows(width, vocabulary)
                    hit = _holds(passing, found)
                    at, found = at[hit], found[hit]
                    text = np.searchsorted(templates.offsets, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(text)),
                            pa.array(np.full(len(at), int(reading), np.int32)),
                            _signed(found),
                            pa.array(np.full(len(at), width, np.int32)),
                            pa.array((at - templates.offsets[text]).astype(np.int32)),
                            pa.array([[templates.value(i) for i in range(k, k + width)] for k in at.tolist()], pa.list_(pa.binary())),
                        ],
                        ["doc_id", "reading", "hash", "width", "at", "words"],
                    )

    rows = docs.select("doc_id", text_bytes(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, reading int, hash long, width int, at int, words array<binary>")


def _run_of(places: Column, width: Column) -> Column:
    """tokens and run: how many tokens windows of a width at these places cover, in all and most in a row."""

    def add(state: Column, at: Column) -> Column:
        new = F.least(width, at - state.last)
        run = F.when(at - state.last <= width, state.now + new).otherwise(width)
        return F.struct(
            (state.tokens + new).alias("tokens"), run.alias("now"), F.greatest(state.run, run).alias("run"), at.alias("last")
        )

    zero, never = F.lit(0), F.lit(-(1 << 20))
    start = F.struct(zero.alias("tokens"), zero.alias("now"), zero.alias("run"), never.alias("last"))
    return F.aggregate(F.array_sort(places), start, add)


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """Pairs of a document and a benchmark template it contains.

    Columns: doc_id, item_id (the smallest of the template), n_items, n_windows (of the item's that the
    document has), coverage, n_slots, consistency. A document has an item if an alignment has at least ``coverage``
    of its tokens or RUN in a row, or if it is the one with most windows and the document has at least
    ``coverage`` of all; along it, at least ``consistency`` of the item's slots must hold one value each, also without
    words that only begin sentences. The best such alignment is shown. Null and empty texts contain nothing;
    repeated rows count once; an empty table on either side gives no rows. Documents and items with a null id
    are left out, as a pair could not name them; other columns are ignored, whatever their names. Ties between
    alignments go to the smaller shift, then to the first reading.
    """
    known = keep(item_windows(items))
    shift = F.shiftrightunsigned(F.col("hash"), 64 - FILTER_BITS).cast("int").alias("cell")
    cells, words = _cells(known.select(shift).distinct()), _cells(item_words(items))
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())
    found = document_windows(docs.filter(F.col("doc_id").isNotNull()), cells, words, widths)
    pair = ["doc_id", "item_id", "n_items", "reading", "n_windows", "n_tokens", "width"]
    line = [*pair, "shift"]
    aligned = found.alias("d").join(known.alias("k"), ["reading", "hash", "width"]).select(
        *pair, "hash", F.col("k.at").alias("at"), (F.col("d.at") - F.col("k.at")).alias("shift"),
        F.transform("slots", lambda s: F.struct(s.slot.alias("slot"), s.sure.alias("sure"), F.get("words", s.at).alias("word"))).alias("slots"),
    )
    matched = keep(aligned)
    covered = matched.select(*pair, "hash").distinct().groupBy(*pair).agg(F.count("*").alias("found"))
    lines = matched.groupBy(*line).agg(F.collect_set("at").alias("places"))
    lines = lines.withColumn("on_line", F.size("places")).withColumn("covers", _run_of(F.col("places"), F.col("width"))).drop("places")
    order = [F.desc("on_line"), "shift"]
    best = F.row_number().over(Window.partitionBy(*pair).orderBy(*order))
    lines = lines.withColumn("best", best)
    values = matched.select(*line, F.explode("slots").alias("s")).groupBy(*line, "s.slot", "s.sure").agg(F.count_distinct("s.word").alias("n"))
    single = (F.col("n") == 1).cast("double")
    both = F.least(F.avg(single), F.avg(F.when(F.col("sure"), single)))
    slots = values.groupBy(*line).agg(F.count("*").alias("n_slots"), both.alias("consistency"))
    share = F.col("found") / F.col("n_windows")
    whole = (F.col("covers.tokens") >= coverage * F.col("n_tokens")) | (F.col("covers.run") >= RUN)
    kept = (
        lines.join(slots, line, "left")
        .join(covered, pair)
        .withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
        .filter((whole | (F.col("best") == 1) & (share >= coverage)) & (F.col("consistency") >= consistency))
    )
    shown = F.row_number().over(Window.partitionBy("doc_id", "item_id", "n_items").orderBy(F.desc(share), *order, "reading"))
    return kept.withColumn("shown", shown).filter("shown = 1").select(
        "doc_id",
        "item_id",
        "n_items",
        F.col("found").alias("n_windows"),
        share.alias("coverage"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        "consistency",
    )


@query("op8_benchmark_templates")
def op8_benchmark_templates(spark, sf):
    return leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
