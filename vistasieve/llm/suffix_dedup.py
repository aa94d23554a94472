"""Exact substring dedup with suffix arrays sorted by bucket-pointer refinement.

A byte goes when it is covered by a string of ``length`` bytes that also starts in a document with a smaller id.
Equal strings of that length have the same minimizer (the least hashed ``GRAM``-gram in them, leftmost if tied), so each
maximal run of string starts with one minimizer is a context, and equal strings meet in the shard of that minimizer:

1. every block sends the hashes of its minimizers; shards answer which of them occur in two documents;
2. blocks send the contexts of those, equal ones once with their least document id;
3. a shard sorts the suffixes of contexts that share a minimizer but differ: initial 8-gram buckets, refined by sorting
   on the bucket numbers of the suffixes 8, 16 and then 18 bytes further on, each round reusing the buckets that the
   last one refined, until buckets hold equal strings; the least id of each bucket goes back to the blocks;
4. blocks mark the strings whose least id is below their own document's and cut the covered bytes.

A passage in any number of documents costs one context per block. Hashes only bring strings together: the suffix sort
compares bytes, and contexts are told apart by their bytes.

Defined cases: a null text is empty; a null id counts as larger than all others; rows that share an id never remove
each other's bytes; copies with one id tie and all stay; a text is never split, so a very long one is a
block by itself (its first step took 1.2 times the text, later ones up to ten times where it repeats itself); an empty
table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm import exchange
from vistasieve.llm.common import offsets, ranges

GRAM = 24
FIRST = 8                   # bytes of the initial buckets
SEGMENT = 1 << 20
NO_ID = np.iinfo(np.int64).max
_RNG = np.random.default_rng(50)
_BYTE = _RNG.integers(0, 2**64, 256, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)
_KEY = np.uint64((1 << 40) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0xD6E8FEB86659FD93
_POW, _INV = _powers(_BASE, SEGMENT + 4096), _powers(pow(_BASE, -1, 1 << 64), SEGMENT + 4096)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = np.minimum(x[:-step], x[step:]), have + step
    return x


def contexts(text: np.ndarray, doc_at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First string start, number of string starts and minimizer hash of each context of the documents in ``text``."""
    firsts, counts, hashes = [], [], []
    for s in range(0, len(text) - length + 1, SEGMENT):
        seg = text[s:s + SEGMENT + length - 1]
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(_BYTE[seg] * _POW[:len(seg)], out=total[1:])
        gram = (total[GRAM:] - total[:-GRAM]) * _INV[:len(seg) - GRAM + 1]
        gram ^= gram >> np.uint64(32)
        gram *= _MIX
        gram ^= gram >> np.uint64(29)
        least = _sliding_min((gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64), length - GRAM + 1)
        at = (least & _LOW).astype(np.int32)
        for end in doc_at[np.searchsorted(doc_at, s, "right"):np.searchsorted(doc_at, s + len(seg), "left")].tolist():
            at[max(0, end - length + 1 - s):end - s] = -1  # strings that would cross the document's end
        edge = np.flatnonzero(np.diff(at, prepend=-2, append=-2))
        first, size = edge[:-1], np.diff(edge)
        good = at[first] >= 0
        firsts.append(first[good] + s)
        counts.append(size[good])
        hashes.append(gram[at[first[good]]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(hashes)


def bucket_pointers(text: np.ndarray, length: int) -> np.ndarray:
    """Bucket number of the suffix at each position: equal for suffixes that agree on ``length`` bytes (a suffix that
    is shorter counts as followed by zeros). Numbers ascend in suffix order."""
    n = len(text)
    padded = np.r_[text, np.zeros(FIRST, np.uint8)]
    word = np.zeros(n, np.uint64)
    for j in range(FIRST):
        word = word << np.uint64(8) | padded[j:n + j]
    order = np.argsort(word, kind="stable")
    bucket = np.empty(n, np.int64)

    def split(slots, new):
        """Give the sorted suffixes in ``slots`` their buckets' first slots; returns which buckets hold several."""
        bucket[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        return ~(new & np.r_[new[1:], True])

    slots, word = np.arange(n), word[order]
    several = split(slots, np.r_[True, word[1:] != word[:-1]])
    depth = FIRST
    while depth < length and (slots := slots[several]).size:
        step = min(depth, length - depth)
        suffix = order[slots]
        own, later = bucket[suffix], np.where(suffix + step < n, bucket[np.minimum(suffix + step, n - 1)], -1)
        by = np.lexsort((later, own))
        order[slots], own, later = suffix[by], own[by], later[by]
        several = split(slots, np.r_[True, (own[1:] != own[:-1]) | (later[1:] != later[:-1])])
        depth += step
    return bucket


def distinct(text: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one context for each distinct byte string, and each context's number among those."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = int(size.max(initial=0))
    rows = np.zeros((len(first), width + 2), np.uint8)  # two bytes, never zero, tell lengths apart
    rows[:, :width][np.arange(width) < size[:, None]] = text[ranges(first, size)]
    rows[:, width], rows[:, width + 1] = 1 + size // 255, 1 + size % 255
    _, index, number = np.unique(rows.view(f"S{width + 2}").ravel(), return_index=True, return_inverse=True)
    return index, number


class Block:
    """A block's documents, contexts and the order in which minimizers and contexts are asked about."""

    def __init__(self, payload: bytes, length: int, shards: int):
        ids, lens, body = exchange.unpack(payload)
        self.ids, self.lens = np.frombuffer(ids, np.int64), np.frombuffer(lens, np.int64)
        self.text, self.at = np.frombuffer(body, np.uint8), offsets(self.lens)
        self.first, self.count, gram = contexts(self.text, self.at[1:], length)
        self.owner = self.ids[np.searchsorted(self.at, self.first, "right") - 1]
        key = ((gram >> np.uint64(40)) % np.uint64(shards)) << np.uint64(40) | (gram & _KEY)
        self.keys, self.number = np.unique(key, return_inverse=True)
        self.length = length

    def by_shard(self, shard: np.ndarray):
        """(shard, its slice) for ascending ``shard`` numbers."""
        edge = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)).tolist()
        return [(int(shard[a]), slice(a, b)) for a, b in zip(edge, edge[1:])]

    def ask_minimizers(self) -> list[tuple[int, bytes]]:
        order = np.argsort(self.number, kind="stable")
        starts = np.flatnonzero(np.diff(self.number[order], prepend=-1))
        owner = self.owner[order]
        both = (np.minimum.reduceat(owner, starts) < np.maximum.reduceat(owner, starts)) if len(starts) else np.zeros(0, bool)
        low = self.keys.view(np.uint8).reshape(-1, 8)[:, :5]
        shard = (self.keys >> np.uint64(40)).astype(np.int64)
        return [(s, exchange.pack(low[part], both[part])) for s, part in self.by_shard(shard)]

    def select(self, answers: list[bytes]) -> None:
        """Keep the contexts whose minimizer is shared; find equal ones."""
        shard = (self.keys >> np.uint64(40)).astype(np.int64)
        shared = np.zeros(len(self.keys), bool)
        for (_, part), got in zip(self.by_shard(shard), answers, strict=True):
            shared[part] = np.frombuffer(exchange.unpack(got)[0], bool)
        own = shared[self.number]
        self.first, self.count, self.owner, self.number = (x[own] for x in (self.first, self.count, self.owner, self.number))
        index, number = distinct(self.text, self.first, self.count + self.length - 1)
        order = np.argsort(self.number[index], kind="stable")  # ascending keys, so ascending shards
        self.index = index[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.context = place[number]
        self.context_shard = shard[self.number[self.index]]

    def ask_contexts(self) -> list[tuple[int, bytes]]:
        least = np.full(len(self.index), NO_ID)
        np.minimum.at(least, self.context, self.owner)
        first, size, key = self.first[self.index], self.count[self.index] + self.length - 1, self.keys[self.number[self.index]]
        return [(s, exchange.pack(key[p], size[p].astype(np.int32), least[p], self.text[ranges(first[p], size[p])]))
                for s, p in self.by_shard(self.context_shard)]

    def removed(self, answers: list[bytes]) -> np.ndarray:
        """Which bytes of the block go, from the least ids of the strings in each context."""
        parts = []
        for got in answers:
            least, runs = exchange.unpack(got)
            parts.append(np.repeat(np.frombuffer(least, np.int64), np.frombuffer(runs, np.int32)))
        least = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        at = offsets(self.count[self.index])[:-1][self.context]
        hit = ranges(self.first, self.count)[least[ranges(at, self.count)] < np.repeat(self.owner, self.count)]
        change = np.bincount(hit, minlength=len(self.text) + 1) - np.bincount(hit + self.length, minlength=len(self.text) + 1)
        return np.cumsum(change)[:-1] > 0


def shared_minimizers(payloads: list[bytes]) -> tuple[list[bytes], list[int]]:
    keys, both = [], []
    for p in payloads:
        low, flag = exchange.unpack(p)
        wide = np.zeros((len(flag), 8), np.uint8)
        wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
        keys.append(wide.view(np.uint64).ravel())
        both.append(np.frombuffer(flag, bool))
    values, number, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = (count > 1) | (np.bincount(number[np.concatenate(both)], minlength=len(values)) > 0)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [exchange.pack(part) for part in np.split(shared[number], cuts)], []


def least_owners(payloads: list[bytes], length: int) -> tuple[list[bytes], list[int]]:
    """For each block's contexts, the least document id of each of their strings, as runs."""
    columns = [[np.frombuffer(x, t) for x, t in zip(exchange.unpack(p), (np.uint64, np.int32, np.int64, np.uint8))]
               for p in payloads]
    key, size, least, text = (np.concatenate(c) for c in zip(*columns))
    index, number = distinct(text, offsets(size)[:-1], size.astype(np.int64))
    owner = np.full(len(index), NO_ID)
    np.minimum.at(owner, number, least)
    first, size, key = offsets(size)[:-1][index], size[index].astype(np.int64), key[index]
    strings = size - length + 1
    result = np.repeat(owner, strings)  # of all strings of all distinct contexts
    at = offsets(strings)
    _, group, members = np.unique(key, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(members[group] > 1)  # minimizers with differing contexts
    if mixed.size:
        body = text[ranges(first[mixed], size[mixed])]
        where = ranges(offsets(size[mixed])[:-1], strings[mixed])
        bucket = bucket_pointers(body, length)[where]
        slot = ranges(at[mixed], strings[mixed])
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        low = np.minimum.reduceat(result[slot[order]], starts)
        result[slot[order]] = np.repeat(low, np.diff(np.r_[starts, len(order)]))
    out, done = [], 0
    for c in columns:
        own = number[done:done + len(c[1])]
        done += len(own)
        values = result[ranges(at[own], strings[own])]
        edge = np.flatnonzero(np.diff(values, prepend=-1 if not len(values) else values[0] - 1))
        out.append(exchange.pack(values[edge], np.diff(np.r_[edge, len(values)]).astype(np.int32)))
    return out, []


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (bytes)."""
    if length < 32:
        raise ValueError("length must be at least 32 bytes")
    shards = exchange.shards_for(docs, text)

    def build(ids, bodies):
        bodies = [b or b"" for b in bodies]
        return exchange.pack(np.array([NO_ID if i is None else i for i in ids], np.int64),
                             np.array([len(b) for b in bodies], np.int64), b"".join(bodies))

    def ask_minimizers(payload, _):
        return Block(payload, length, shards).ask_minimizers()

    def ask_contexts(payload, shared):
        block = Block(payload, length, shards)
        block.select(shared)
        return [(shards + s, q) for s, q in block.ask_contexts()]

    def cut(_, payload, answers):
        block = Block(payload, length, shards)
        n = len(block.by_shard((block.keys >> np.uint64(40)).astype(np.int64)))
        block.select(answers[:n])
        gone = block.removed(answers[n:])
        starts = np.flatnonzero(np.diff(gone, prepend=False) & gone)
        starts = np.unique(np.r_[starts, block.at[:-1][block.lens > 0][gone[block.at[:-1][block.lens > 0]]]])
        left = offsets(~gone)
        kept = block.text[~gone].tobytes()
        removed = block.lens - np.diff(left[block.at])
        spans = np.diff(np.searchsorted(starts, block.at))
        for lo in range(0, len(block.ids), 1000):
            hi = min(lo + 1000, len(block.ids))
            cuts = left[block.at[lo:hi + 1]].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == NO_ID else i for i in block.ids[lo:hi].tolist()], pa.int64()),
                 pa.array(block.lens[lo:hi]), pa.array(removed[lo:hi]), pa.array(spans[lo:hi]),
                 pa.array([kept[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    blocks = exchange.make_blocks(rows, build)
    shared = exchange.answer(exchange.questions(blocks, None, ask_minimizers), shared_minimizers, "minimizers", shards)
    least = exchange.answer(exchange.questions(blocks, shared, ask_contexts), lambda p: least_owners(p, length), "contexts", shards)
    out = exchange.by_block(blocks, shared.unionByName(least), cut,
                            "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.withColumnRenamed("id", id_col)
