"""License scans by conditional compression.

A block of text that quotes a license compresses much better with that license's wording as a zstandard
raw dictionary than without. Templates are ranked by the bytes they save on a block; those that save enough
win, and winners are confirmed, in order, by the exact differences of their words. Blocks are windows over the
words of the whole text, of a size that follows from the template's, so a notice may be wrapped and of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, read

# Notices as their licenses word them. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
)
CUE = r"(?i)licen[sc]|copyright|warrant|redistribut|permission|permitted|creative\W+commons|\bcc\W+by\b|\bcc0\b|unencumbered"
AGREEMENT = 0.8  # share of a template's words that a notice must have, in order
SPREAD = 1.5  # words from a notice's first to its last, at most, as a multiple of the template's
SAVES = 0.05  # of the bytes that a template's dictionary saves on the template itself, the share to save on a block
LEVEL = 19  # at lower ones, zstandard leaves short literals as they are, so savings jump
MEMORY = 50_000  # blocks a task remembers
_TOKEN = re.compile(r"\w+")
_CUE = re.compile(CUE)


def words_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _compressor(words: Sequence[str] | None = None) -> zstandard.ZstdCompressor:
    """A compressor that has a template's words as raw dictionary, or none."""
    raw = words and zstandard.ZstdCompressionDict(
        " ".join(words).encode().ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=raw or None, write_content_size=False, write_checksum=False, write_dict_id=False
    )


@dataclass(frozen=True)
class Finding:
    license: str
    template: int
    reduction: float  # share of the notice's compressed size that the dictionary saves
    places: tuple[int, ...]  # of the matched words
    matched: int
    missing: int  # words of the template that the notice lacks
    extra: int  # words of the text between the template's first and last that are not its own
    differences: str

    def moved(self, by: int) -> Finding:
        return replace(self, places=tuple(p + by for p in self.places))


def _preference(f: Finding) -> tuple:
    return f.missing + f.extra, -f.reduction, f.template, f.places


class Scanner:
    """Ranks templates by the bytes they save on a block, and confirms the winners by their wording."""

    def __init__(
        self, templates: Sequence[tuple[str, str]], agreement: float, spread: float = SPREAD, saves: float = SAVES
    ):
        self.templates = templates
        self.words = [words_of(text) for _, text in templates]
        self.counts = [Counter(words) for words in self.words]
        self.may_miss = [sum(len(w) - m >= agreement * len(w) for m in range(1, len(w) + 1)) for w in self.words]
        self.spans = [int(spread * len(w)) for w in self.words]
        self.plain = _compressor()
        self.with_template = [_compressor(words) for words in self.words]
        own = [" ".join(words).encode() for words in self.words]
        self.needed = [max(1.0, saves * self.saved(text, i)) for i, text in enumerate(own)]
        self.sizes: dict[int, list[int]] = {}  # half the words of a block, and the templates it suits
        for i, span in enumerate(self.spans):
            if span:
                self.sizes.setdefault(1 << (span - 1).bit_length(), []).append(i)
        self.known: dict[tuple[int, str], tuple[Finding, ...]] = {}

    def saved(self, text: bytes, i: int) -> int:
        """The bytes that a template's dictionary saves on a text."""
        return len(self.plain.compress(text)) - len(self.with_template[i].compress(text))

    def share_saved(self, have: list[str], i: int) -> float:
        text = " ".join(have).encode()
        return self.saved(text, i) / len(self.plain.compress(text))

    def winners(self, block: str, among: Sequence[int]) -> list[int]:
        """The templates that save enough on a block, those that save most first; equal savings keep their order."""
        text = block.encode()
        plain = len(self.plain.compress(text))
        saved = {i: plain - len(self.with_template[i].compress(text)) for i in among}
        return sorted((i for i in among if saved[i] >= self.needed[i]), key=lambda i: (-saved[i], i))

    def _may_hold(self, bag: Counter, i: int) -> bool:
        lacking = {w: n - bag[w] for w, n in self.counts[i].items() if n > bag[w]}
        return sum(lacking.values()) <= self.may_miss[i] and not any(w.isdigit() for w in lacking)

    def compare(self, have: list[str], i: int) -> tuple[list[int], list[str]] | None:
        """Places of the matched words and the missing words, where fewest are missing or put in; None if nowhere.

        An exact alignment: ``extra[j, m]`` is the least number of words put in, if of the template's first j
        words m are missing, up to the current word. Numbers may not be missing: another version is
        another license.
        """
        want, n, most = self.words[i], len(self.words[i]), self.may_miss[i]
        never = np.int32(1 << 20)
        needed = np.array([never if w.isdigit() else 0 for w in want], np.int32)
        places = {w: np.array([v == w for v in want]) for w in self.counts[i]}
        extra = np.full((n + 1, most + 1), never, np.int32)
        steps = []

        def skip() -> None:
            extra[0, 0] = 0
            for m in range(1, most + 1):
                np.minimum(extra[1:, m], extra[:-1, m - 1] + needed, out=extra[1:, m])

        skip()
        steps.append(extra.copy())
        for word in have:
            before = extra.copy()
            extra += 1
            if word in places:
                at = places[word]
                extra[1:][at] = np.minimum(extra[1:][at], before[:-1][at])
            skip()
            np.minimum(extra, never, out=extra)
            steps.append(extra.copy())
        ends = np.array([s[n] for s in steps])  # by place and number of missing words
        cost = ends + np.arange(most + 1)
        cost[ends + n - np.arange(most + 1) > self.spans[i]] = never
        k, m = (int(v) for v in np.unravel_index(int(np.argmin(cost)), cost.shape))
        if cost[k, m] >= never:
            return None
        found, missing, j = [], [], n
        while j:
            now = steps[k][j, m]
            if m and now == steps[k][j - 1, m - 1] + needed[j - 1]:
                missing.append(want[j - 1])
                j, m = j - 1, m - 1
            elif k and have[k - 1] == want[j - 1] and now == steps[k - 1][j - 1, m]:
                found.append(k - 1)
                j, k = j - 1, k - 1
            else:
                k -= 1
        return found[::-1], missing[::-1]

    def _all_of(self, have: list[str], i: int, begin: int, end: int) -> Iterator[Finding]:
        """The notices of a template between two places, the best first, then those before and behind it."""
        part = have[begin:end]
        if not self._may_hold(Counter(part), i):
            return
        at = f" {' '.join(part)} ".find(f" {' '.join(self.words[i])} ")
        if at >= 0:
            first = " ".join(part)[:at].count(" ")
            compared = list(range(first, first + len(self.words[i]))), []
        else:
            compared = self.compare(part, i)
        if compared is None:
            return
        places, missing = [p + begin for p in compared[0]], compared[1]
        taken = set(places)
        more = [have[k] for k in range(places[0], places[-1]) if k not in taken]
        differences = " ".join([f"-{w}" for w in missing] + [f"+{w}" for w in more])
        saved = self.share_saved(have[places[0] : places[-1] + 1], i)
        yield Finding(self.templates[i][0], i, saved, tuple(places), len(places), len(missing), len(more), differences)
        yield from self._all_of(have, i, begin, places[0])
        yield from self._all_of(have, i, places[-1] + 1, end)

    def confirmed(self, have: list[str], size: int) -> tuple[Finding, ...]:
        """The notices in a block of words of the templates that blocks of this size suit."""
        block = " ".join(have)
        if (size, block) not in self.known:
            if len(self.known) >= MEMORY:
                self.known.clear()
            won = self.winners(block, self.sizes[size])
            self.known[size, block] = tuple(f for i in won for f in self._all_of(have, i, 0, len(have)))
        return self.known[size, block]

    def find_all(self, have: list[str]) -> list[Finding]:
        """The notices in the words of a text, without those whose matched words all belong to a better one.

        Of a notice with differences the words may also belong to several better ones: such a notice is only
        put together from their words. Blocks of twice a size overlap by half, so every notice of at most that
        size is inside of one.
        """
        found = {}
        cues = self._cues(have)
        for size in self.sizes:
            last = max(len(have) - size - 1, 0) // size  # of the blocks needed to reach the end
            for k in sorted({b for c in cues for b in (c // size - 1, c // size) if 0 <= b <= last} | ({last} if cues else set())):
                for f in self.confirmed(have[k * size : (k + 2) * size], size):
                    moved = f.moved(k * size)
                    found[moved.template, moved.places] = moved
        better: dict[int, list[frozenset[int]]] = {}  # by a word they match
        out = []
        for f in sorted(found.values(), key=lambda f: (f.missing + f.extra, -f.matched, -f.reduction, f.template, f.places)):
            inside = any(places.issuperset(f.places) for places in better.get(f.places[0], ()))
            if not inside and not (f.differences and all(p in better for p in f.places)):
                out.append(f)
                places = frozenset(f.places)
                for p in f.places:
                    better.setdefault(p, []).append(places)
        return out

    @staticmethod
    def _cues(have: list[str]) -> list[int]:
        """Places of words that a cue begins in."""
        text = " ".join(have)
        if not (begins := [m.start() for m in _CUE.finditer(text)]):
            return []
        firsts = np.cumsum([0] + [len(w) + 1 for w in have])
        return sorted(set((np.searchsorted(firsts, begins, side="right") - 1).tolist()))

    def find(self, block: str) -> Finding | None:
        """The best notice of a text."""
        return next(iter(self.find_all(words_of(block))), None)


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    agreement: float = AGREEMENT,
    spread: float = SPREAD,
    saves: float = SAVES,
) -> DataFrame:
    """License notices: one row per row of ``docs``, line, and license found there.

    Columns: doc_id, line (of the first matched word, from 0), license, reduction, matched, missing, extra,
    differences ("-" words of the template that are missing, "+" words put in). A notice has, in order,
    ``agreement`` of a template's words, its numbers and a cue word, from first to last at most ``spread`` times as
    many words as the template, and its block saves ``saves`` of the bytes the template's dictionary saves on the
    template itself; it may go over line ends. Of notices of one license that begin in one line the one with
    fewest differences counts, then the one that saves the larger share, then the template listed first, then the
    notice that begins first. Null and empty texts have none. Ids are only passed on, so null and shared
    ids keep their rows, and repeated rows give repeated results. An empty table gives no rows; other columns are
    ignored.
    """
    fields = {
        "license": pa.string(),
        "reduction": pa.float64(),
        "matched": pa.int32(),
        "missing": pa.int32(),
        "extra": pa.int32(),
        "differences": pa.string(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, agreement, spread, saves)
        for batch in batches:
            rows, lines, found = [], [], []
            for row, text in enumerate(batch.column("text")):
                low = text.as_py().lower()
                spans = list(_TOKEN.finditer(low))
                best: dict[tuple[int, str], Finding] = {}
                for f in sorted(scanner.find_all([s.group() for s in spans]), key=_preference):
                    best.setdefault((low.count("\n", 0, spans[f.places[0]].start()), f.license), f)
                for (line, _), f in sorted(best.items()):
                    rows.append(row)
                    lines.append(line)
                    found.append(f)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(lines, pa.int32()),
                    *[pa.array([getattr(f, name) for f in found], kind) for name, kind in fields.items()],
                ],
                ["doc_id", "line", *fields],
            )

    cued = docs.select("doc_id", "text").filter(F.col("text").rlike(CUE))
    kind = cued.schema["doc_id"].dataType.simpleString()
    return cued.mapInArrow(
        run,
        f"doc_id {kind}, line int, license string, reduction double, matched int, missing int, extra int, differences string",
    )


@query("op10_license_scan")
def op10_license_scan(spark, sf):
    return scan(read(spark, sf, "documents")).select(
        "doc_id", "line", "license", "matched", "missing", "extra", "differences", F.round("reduction", 6).alias("reduction")
    )
