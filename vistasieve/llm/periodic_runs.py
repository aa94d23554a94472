"""Detection of periodic runs of words with string synchronising sets.

A run is a longest stretch of consecutive words in which words ``q`` apart are equal, ``q`` its smallest period, of at
least ``max(least, 3 q)`` words. Texts are word numbers laid end to end, with a number of its own between two texts.

At every dyadic scale ``t`` (4, 8, 16, ...) each position has an identifier of its next ``t`` words, and position ``i`` is
in the synchronising set if the least identifier of positions ``i .. i+t`` is that of ``i`` or of ``i+t``; positions whose
``t`` words have a period of at most ``t/3`` are left out of the minimum. Whether a position is selected depends on its
next ``2t`` words alone, so the set looks alike wherever the text does. Every run of a period ``q`` with
``(3t-1)/2 <= q < (6t-1)/2`` therefore holds a selected ``i`` of which ``i+q`` is selected too, with the same ``2t`` words, and
fewer than nine selected positions with these words lie between them: selected positions of equal context are sorted
together, and each proposes the distances to its next nine. Proposals are joined where they overlap, extended word by
word both ways, and kept if long enough. Small periods (5 and less) are left out of the sets: their highly periodic
regions are found by themselves, as stretches of equal words ``q`` apart; those of larger periods at coarser scales are
the runs found at the scales before.

A batch of rows is searched together. Memory is about 20 bytes a byte of text for at most ``BLOCK_BYTES`` of text, or
for one text if it is longer (a run may span a whole text, so texts are never cut). No row is shuffled.

Defined cases: null and blank texts have no words and no runs; a text in which all words are equal is one run of
period 1; runs with the same ends are one, with the smallest period; repeated rows and ids, null ids too, are rows of
their own; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import merge_spans, offsets, ranges, slices, with_fields
from vistasieve.llm.words import split_words

BLOCK_BYTES = 4 << 20
SMALL = 5   # periods found as highly periodic regions
NEXT = 9    # occurrences of a context within three scales
_NEVER = np.uint64(2**64 - 1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor(b, np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones, by running minima within blocks of that width."""
    n = len(v) - width + 1
    rows = np.full(-(-len(v) // width) * width, _NEVER, np.uint64)
    rows[:len(v)] = v
    rows = rows.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def stretches(w: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all longest stretches of period ``q`` with at least ``least`` (> q) words."""
    if len(w) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.diff(np.r_[False, w[q:] == w[:-q], False].view(np.int8)))
    lo, hi = edge[0::2], edge[1::2] + q
    kept = hi - lo >= least
    return lo[kept], hi[kept]


def _extend(w: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (upwards or downwards) equal those ``q`` further on, in a row."""
    got, open_, width = np.zeros(len(at), np.int64), np.arange(len(at)), 16
    while len(open_):
        near = at[open_, None] + step * (got[open_, None] + np.arange(width))
        far = near + q[open_, None]
        inside = (near >= 0) & (far < len(w))
        equal = inside & (w[np.where(inside, near, 0)] == w[np.where(inside, far, 0)])
        run = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        got[open_] += run
        open_ = open_[run == width]
        width = min(2 * width, max(16, (1 << 20) // max(1, len(open_))))
    return got


def _proposals(ids: np.ndarray, text: np.ndarray, periodic: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods proposed by equal contexts of the synchronising set of scale ``t``."""
    value = np.where(periodic, _NEVER, ids)
    least = _window_min(value, t + 1)
    chosen = np.flatnonzero(((value[:len(least)] == least) | (value[t:] == least)) & (least != _NEVER))
    chosen = chosen[chosen + t < len(ids)]
    context = _mix(_mix(ids[chosen], ids[chosen + t]), text[chosen].astype(np.uint64))
    order = np.lexsort((chosen, context))
    chosen, context = chosen[order], context[order]
    at, period = [], []
    for k in range(1, NEXT + 1):
        gap = chosen[k:] - chosen[:-k]
        fits = (context[k:] == context[:-k]) & (2 * gap >= 3 * t - 1) & (2 * gap < 6 * t - 1)
        at.append(chosen[:-k][fits])
        period.append(gap[fits])
    return np.concatenate(at), np.concatenate(period)


def find_runs(w: np.ndarray, text: np.ndarray, least: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the word numbers ``w``, ordered by start and period. ``text`` (ascending)
    tells texts apart, and a number that occurs nowhere else must lie between two texts."""
    sizes = np.bincount(text) if len(text) else np.zeros(0, np.int64)
    longest = int(sizes.max(initial=0))
    found = [(*stretches(w, q, max(least, 3 * q)), q) for q in range(1, SMALL + 1)]
    lo, hi, per = (np.concatenate(x) for x in zip(*((s, e, np.full(len(s), q)) for s, e, q in found)))
    dense = [(*stretches(w, q, 3 * q), q) for q in range(1, SMALL + 1)]
    small = tuple(np.concatenate(x) for x in zip(*((s, e, np.full(len(s), q)) for s, e, q in dense)))
    ids = _mix(w.astype(np.uint64), np.zeros(len(w), np.uint64))
    ids = _mix(ids[:-1], ids[1:])
    place, t = np.arange(len(w)), 4
    while 9 * t - 3 <= 2 * longest:  # a run of this scale has at least three times (3t-1)/2 words
        whole = 2 * sizes[text] >= 9 * t - 3  # shorter texts take no part from here on
        if not whole.all():
            kept = np.flatnonzero(whole)
            # what follows a kept position is a kept one as far as its text goes; behind that, anything will do
            ids, w, text, place = ids[kept[kept < len(ids)]], w[kept], text[kept], place[kept]
        half = t // 2
        ids = _mix(ids[:-half], ids[half:])
        s, e, q = (np.concatenate(x) for x in zip(small, (lo, hi, per)))
        dense_here = (3 * q <= t) & (e - s >= t)
        mark = np.zeros(len(ids) + 1, np.int32)
        s, e = np.searchsorted(place, s[dense_here]), np.searchsorted(place, e[dense_here])
        same = e - s >= t  # stretches of texts that still take part
        np.add.at(mark, s[same], 1)
        np.add.at(mark, np.minimum(e[same] - t + 1, len(ids)), -1)
        at, period = _proposals(ids, text, np.cumsum(mark)[:-1] > 0, t)
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        # one proposal for each chain of overlapping ones of a period
        first = np.flatnonzero(np.r_[True, (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * t)][:len(at)])
        at, period = at[first], period[first]
        up, down = _extend(w, at, period, 1), _extend(w, at - 1, period, -1)
        long = (up + down + period >= np.maximum(least, 3 * period)) & (up > 0)
        s, e, q = (at - down)[long], (at + up + period)[long], period[long]
        lo, hi, per = np.r_[lo, place[s]], np.r_[hi, place[e - 1] + 1], np.r_[per, q]
        order = np.lexsort((per, hi, lo))
        lo, hi, per = lo[order], hi[order], per[order]
        new = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])][:len(lo)]  # the smallest period of equal ends
        lo, hi, per, t = lo[new], hi[new], per[new], 2 * t
    order = np.lexsort((per, hi, lo))
    lo, hi, per = lo[order], hi[order], per[order]
    new = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])][:len(lo)]
    lo, hi, per = lo[new], hi[new], per[new]
    order = np.lexsort((per, lo))
    return lo[order], hi[order], per[order]


def runs_of_texts(bodies: list[bytes | None], least: int = 24):
    """For all texts: how many runs each has; start, length and period of the runs; and the texts without repeats."""
    words = split_words(bodies)
    count = np.bincount(words.text, minlength=len(bodies))
    first = offsets(count)
    # a number of its own behind each text
    numbers = np.insert(words.number.astype(np.int64), first[1:], len(words.names) + np.arange(len(bodies)))
    text = np.insert(words.text, first[1:], np.arange(len(bodies)))
    lo, hi, per = find_runs(numbers, text, least)
    of = text[lo] if len(lo) else np.zeros(0, np.int64)
    gone_lo, gone_hi = merge_spans(lo + per, hi)
    gone = np.zeros(len(numbers), bool)
    gone[ranges(gone_lo, gone_hi - gone_lo)] = True
    gone = np.delete(gone, first[1:] + np.arange(len(bodies)))
    raw, left = memoryview(words.body), []
    for i, body in enumerate(bodies):
        a, b = first[i], first[i + 1]
        if not gone[a:b].any():
            left.append(b" ".join((body or b"").split()))
        else:
            kept = a + np.flatnonzero(~gone[a:b])
            left.append(b" ".join(bytes(raw[s:e]) for s, e in zip(words.start[kept].tolist(), words.end[kept].tolist())))
    return np.bincount(of, minlength=len(bodies)), lo - first[of] - of, hi - lo, per, count, left


def periodic_runs(docs: DataFrame, least: int = 24, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``n_words``, ``runs`` (start, length and period, by start and then period) and ``collapsed``: the words that no
    run contains behind its first period, with one space between them."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(text).cast("binary").alias("body"))

    def run(batches):
        for piece in slices(batches, "body", BLOCK_BYTES):
            many, start, length, period, count, left = runs_of_texts(piece.column("body").to_pylist(), least)
            runs = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)],
                                              names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(offsets(many).astype(np.int32), runs),
                 pa.array(left, pa.binary()).cast(pa.string())], names=[id_col, "n_words", "runs", "collapsed"])

    more = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(run, with_fields(docs, id_col, more))
