"""Many weighted draws in one pass.

Draw ``s`` takes the row with the least ``-ln(u) / w``, where ``u`` is a hash of seed, ``s`` and the row's id, and
``w`` is the row's weight at that draw: the sum of its distances to all centres drawn before. So draws depend on
each other only by the weights, and those only grow. A pass hashes every row for all its draws and keeps those
rows that can win one, whichever centres the draws before it in the pass bring: by the triangle inequality a
weight grows by at most the row's distance to a point plus the centre's. How far the pass's own centres are from
that point is assumed here and checked by whoever runs the draws off, one after another, on the few rows kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from . import sums

TILE = 1 << 16  # hashes computed at once
KEPT_ROWS = 1 << 16  # rows that a task keeps, besides KEPT_PER_DRAW; beyond it, it takes on fewer draws
KEPT_PER_DRAW = 8
SLACK = 1 + 1e-6  # well above the rounding of a sum of distances
LEAST, MOST = 1e-290, 1e290  # weights between them, and zero, have finite bounds

_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORD = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]
_BEGIN = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_MESSAGE_BYTES = 55  # what fits into one block


def _first_word(words: Sequence[int | np.ndarray], n: int) -> np.ndarray:
    """The first word of the MD5 of n one-block messages, given as 16 words; the last three steps don't touch it."""
    a, b, c, d = (np.full(n, v, np.uint32) for v in _BEGIN)
    f, high = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        word = words[_WORD[i]]
        np.add(f, a, out=f)
        if isinstance(word, int):
            np.add(f, np.uint32((_ADDED[i] + word) % 2**32), out=f)
        else:
            np.add(f, np.uint32(_ADDED[i]), out=f)
            np.add(f, word, out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=high)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, high, out=f)
        np.add(b, f, out=a)
        a, b, c, d = d, a, b, c
    return b + np.uint32(_BEGIN[0])


class Messages:
    """The ids of some rows, as words of the messages "prefix + id"; a missing id leaves out the last colon, too."""

    def __init__(self, ids: Sequence[bytes | None]):
        self.ids = ids
        self.sizes = np.array([-1 if i is None else len(i) for i in ids], dtype=np.int64)
        short = [b"" if i is None or len(i) > _MESSAGE_BYTES else i for i in ids]
        width = max(map(len, short)) // 4 * 4 + 4
        ended = np.frombuffer(b"".join((i + b"\x80").ljust(width, b"\0") for i in short), np.uint8).reshape(-1, width)
        self.words = []  # by the number of bytes that the prefix leaves in a word
        for odd in range(4):
            moved = np.zeros((len(ids), width + 4), np.uint8)
            moved[:, odd : odd + width] = ended
            self.words.append(np.ascontiguousarray(moved.view("<u4").T))

    def heads(self, prefixes: Sequence[bytes]) -> np.ndarray:
        """The first 32 bits of the MD5 of every prefix with every id; the prefixes have one length."""
        size, n = len(prefixes[0]), len(self.ids)
        full, odd = divmod(size, 4)
        lead = b"".join(p.ljust(4 * full + 4, b"\0") for p in prefixes)
        lead = np.frombuffer(lead, "<u4").reshape(len(prefixes), full + 1)
        words = [np.repeat(lead[:, i], n) for i in range(full)]
        words.append((lead[:, full:] | self.words[odd][0]).ravel())
        words += [np.tile(w, len(prefixes)) if w.any() else 0 for w in self.words[odd][1:]]
        bits = (8 * (size + self.sizes)).astype(np.uint32)
        words = [*(words + [0] * 14)[:14], np.tile(bits, len(prefixes)), 0]
        found = _first_word(words, n * len(prefixes)).byteswap().reshape(len(prefixes), n)
        other: dict[bytes | None, list[int]] = {}
        for i in np.flatnonzero((self.sizes < 0) | (size + self.sizes > _MESSAGE_BYTES)):
            other.setdefault(self.ids[i], []).append(i)
        for one, rows in other.items():
            for k, p in enumerate(prefixes):
                message = p[:-1] if one is None else p + one
                digest = hashlib.md5(message, usedforsecurity=False).digest()
                found[k, rows] = int.from_bytes(digest[:4], "big")
        return found


def summed_distances(x: np.ndarray, centres: np.ndarray, so_far: np.ndarray) -> np.ndarray:
    """A number per row plus the row's distances to some centres, one after another."""
    out = so_far.copy()
    if not 0 < x.shape[1] < 8:
        for c in centres:
            out += np.sqrt(((x - c) ** 2).sum(axis=1))
        return out
    columns = np.ascontiguousarray(x.T)  # the same sums: NumPy adds fewer than eight numbers from the first to the last
    for c in centres:
        total = np.square(columns[0] - c[0])
        for column, at in zip(columns[1:], c[1:]):
            gap = column - at
            total += np.square(gap, out=gap)
        out += np.sqrt(total, out=total)
    return out


def exact_weights(x: np.ndarray, centres: np.ndarray, so_far: np.ndarray) -> np.ndarray:
    """``summed_distances`` of few rows to many centres, added in the same order."""
    out, most = so_far.copy(), max(1, sums.ASSIGN_CELLS // max(centres.size, 1))
    for begin in range(0, len(x), most):
        rows = slice(begin, begin + most)
        apart = np.sqrt(((x[rows, None, :] - centres) ** 2).sum(axis=2))
        out[rows] = np.column_stack([so_far[rows], apart]).cumsum(axis=1)[:, -1]
    return out


def can_win(
    seed: int, first: int, draws: int, newest: np.ndarray, middle: np.ndarray, each: float, once: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a task's rows ``(id, f, weight, key)`` those that can win a draw from ``first`` on, per draw.

    ``weight`` lacks the distances to ``newest``, and ``key`` is the id as a string. The first t centres that are
    drawn in the pass are taken to be at most ``t * each + once`` from ``middle``, all together. Emits ``(step, id,
    f, weight, low, high)``: the row's race is not below ``low``, and the winner's not above ``high``. Where a task
    cannot take on all draws, a row with ``f`` missing names the first one left out; that is ``first`` itself if
    weights are beyond what numbers can bound.
    """
    dim, most_kept = len(middle), KEPT_ROWS + KEPT_PER_DRAW * draws

    def bound(heads, weight):
        return -np.log(heads * 2.0**-32) / weight * SLACK

    def run(batches):
        least, taken, held, n_held, kind = np.full(draws, np.inf), draws, [], 0, None

        def fewer():
            for rows in held:
                step = rows["step"].to_numpy() - first
                rows = rows.filter(pa.array((rows["low"].to_numpy() <= least[step]) & (step < taken)))
                if rows.num_rows:
                    yield rows

        for batch in batches:
            ids = [None if k is None else k.encode() for k in batch.column("key").to_pylist()]
            x = sums.vectors(batch.column("f"), dim)
            rows = list({(k, v.tobytes()): i for i, (k, v) in enumerate(zip(ids, x))}.values())  # equal rows tie
            if len(rows) < len(ids):
                ids, x, batch = [ids[i] for i in rows], x[rows], batch.take(pa.array(rows))
            if not ids:
                continue
            weight = summed_distances(x, newest, sums.scalars(batch.column("weight")))
            grows = np.sqrt(((x - middle) ** 2).sum(axis=1)) + each
            kind = batch.schema.field("id").type
            known = (weight == 0) | (weight > LEAST)
            if not (known & (weight + draws * grows + once < MOST)).all():
                held, taken = [], 0
                break
            messages, t = Messages(ids), 0
            while t < taken:
                digits = 10 ** len(str(first + t)) - first
                end = min(taken, digits, t + max(1, TILE // len(ids)))
                heads = messages.heads([f"{seed}:{first + s}:".encode() for s in range(t, end)])
                missed = np.invert(heads) * 2.0**-32  # 1 - u at least, which is below -ln(u)
                after = np.arange(t, end, dtype=float)[:, None]
                weighs = (weight + after * grows + np.where(after > 0, once, 0.0)) * SLACK
                with np.errstate(divide="ignore", invalid="ignore"):
                    low = missed / weighs
                    if not weight.all():
                        low[weighs == 0] = np.inf
                    front = low.argmin(axis=1)
                    reached = least[t:end]
                    np.minimum(reached, bound(heads[np.arange(end - t), front], weight[front]), out=reached)
                    step, row = np.nonzero(low <= reached[:, None])
                    some = np.isfinite(low[step, row])
                    step, row = step[some], row[some]
                    high = bound(heads[step, row], weight[row])
                np.minimum.at(reached, step, high)
                low = -np.log1p(-missed[step, row]) / weighs[step, row]
                fit = low <= reached[step]
                step, row = step[fit], row[fit]
                held.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array(step + t + first, pa.int32()),
                            batch.column("id").take(pa.array(row)),
                            sums.list_array(x[row]),
                            pa.array(weight[row]),
                            pa.array(low[fit]),
                            pa.array(high[fit]),
                        ],
                        names=["step", "id", "f", "weight", "low", "high"],
                    )
                )
                t = end
                n_held += len(step)
                if n_held > most_kept:
                    held = list(fewer())
                    upto = sum(np.bincount(h["step"].to_numpy() - first, minlength=taken) for h in held).cumsum()
                    if upto[-1] > most_kept // 2:
                        taken = max(1, int(np.searchsorted(upto, most_kept // 4, side="right")))
                        held = list(fewer())
                    n_held = sum(h.num_rows for h in held)
        yield from fewer()
        if taken < draws:
            gap = [pa.array([first + taken], pa.int32()), pa.nulls(1, kind), pa.nulls(1, pa.list_(pa.float64()))]
            gap += [pa.nulls(1, pa.float64())] * 3
            yield pa.RecordBatch.from_arrays(gap, names=["step", "id", "f", "weight", "low", "high"])

    return run
