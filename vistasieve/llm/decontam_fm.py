"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded batch of documents. Its words become integers (words that occur in no phrase share the number 0
and end a run), the suffix array of the runs gives a BWT kept as a wavelet matrix with popcount ranks, every phrase is
searched backwards through it, occurrences are located by walking to sampled suffix positions, and the word spans are
merged per document. Runs shorter than the shortest phrase cannot hold one and are left out before indexing.

Phrases are broadcast in blocks of about ``block_bytes`` of benchmark text, kept as word numbers, so that a block sends a few
times that at most (all its words different: 150 MB once unpacked, at 8 MB of text); a larger benchmark takes one pass
per block over a table written between passes. A document is never cut: a text takes about eight times its size in
the task that has it.

Defined cases: null or wordless texts have no words, hit nothing and count as clean; items without words are ignored; a null item_id adds hits but no item;
an empty benchmark leaves every document clean; repeated rows (also of one doc_id) are judged one by one; repeated
items each count; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import merge_spans, offsets, ranges, slices, utf8, with_fields, written
from vistasieve.llm.words import split_words

#: Bytes that are part of a word map to themselves, A-Z to a-z, all others to a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
SAMPLE_EVERY = 16  # text positions between two sampled suffixes
WINDOWS_AT_ONCE = 1 << 16  # windows that are searched together


def words_of(body: bytes | None) -> list[bytes]:
    return body.translate(WORD_BYTES).split() if body else []


class Bits:
    """A bit vector with rank: packed words, and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.words = np.packbits(np.r_[bits, np.zeros(-len(bits) % 64 + 64, bool)], bitorder="little").view(np.uint64)
        self.before = offsets(np.bitwise_count(self.words))
        self.zeros = len(bits) - int(bits.sum())

    def rank1(self, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, top: int):
        self.levels, seq = [], seq.copy()
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (seq >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit)))
            seq = np.r_[seq[~bit], seq[bit]]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo = np.zeros_like(at)
        for shift, bits in self.levels:
            one, a, b = (symbol >> shift & 1) == 1, bits.rank1(lo), bits.rank1(at)
            lo, at = np.where(one, bits.zeros + a, lo - a), np.where(one, bits.zeros + b, at - b)
        return at - lo

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position and how often it occurs before it."""
        symbol, lo = np.zeros_like(at), np.zeros_like(at)
        for shift, bits in self.levels:
            one, a, b = bits.get(at), bits.rank1(lo), bits.rank1(at)
            symbol |= one.astype(np.int64) << shift
            lo, at = np.where(one, bits.zeros + a, lo - a), np.where(one, bits.zeros + b, at - b)
        return symbol, at - lo


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling over the suffixes still tied; each 0 ends its run and is a symbol of its own."""
    n, ends = len(seq), seq == 0
    rank = np.where(ends, np.cumsum(ends) - 1, seq + ends.sum())
    sa = np.argsort(rank, kind="stable")
    rank_of = np.empty(n, np.int64)

    def renumber(part, key):  # part: slots of the suffix array, sorted by (group, key) already
        new = np.r_[True, key[1:] != key[:-1]]
        rank_of[sa[part]] = part[np.maximum.accumulate(np.where(new, np.arange(len(part)), 0))]
        return ~(new & np.r_[new[1:], True])

    slots = np.arange(n)
    tied = renumber(slots, rank[sa])
    depth = 1
    while (slots := slots[tied]).size:
        group = rank_of[sa[slots]]
        later = rank_of[np.minimum(sa[slots] + depth, n - 1)]
        order = np.lexsort((later, group))
        sa[slots] = sa[slots][order]
        tied = renumber(slots, group[order] * n + later[order])
        depth *= 2
    return sa


class FMIndex:
    """FM-index of runs of positive integers, each run ended by a 0."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.n = len(seq)
        sa = suffix_array(seq)
        last = seq[sa - 1]
        self.first = offsets(np.bincount(seq, minlength=sigma + 2))
        self.bwt = WaveletMatrix(last, sigma + 1)
        starts = np.r_[True, seq[:-1] == 0]
        sampled = ((np.arange(self.n) % SAMPLE_EVERY == 0) | starts)[sa]
        self.sampled, self.positions = Bits(sampled), sa[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges of equally long phrases (rows), all searched together, last word first."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            lo[live] = self.first[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.first[c] + self.bwt.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
        hi = np.maximum(hi, lo)
        dead = np.ones(len(phrases), bool)
        dead[live] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array slots: step back through the BWT to the next sampled suffix."""
        out, at, steps = np.empty(len(slots), np.int64), slots.copy(), 0
        todo = np.arange(len(slots))
        while todo.size:
            there = self.sampled.get(at)
            out[todo[there]] = self.positions[self.sampled.rank1(at[there])] + steps
            todo, at = todo[~there], at[~there]
            symbol, before = self.bwt.access(at)
            at, steps = self.first[symbol] + before, steps + 1
        return out


class Phrases:
    """The windows of a block of benchmark items: the items' words as numbers, end to end, and where windows of each
    length begin and whose they are. About 12 bytes a word, besides each distinct word once."""

    def __init__(self, items: list[tuple], width: int):
        self.number: dict[bytes, int] = {}
        self.ids = [item for item, _ in items]
        parts = [np.fromiter((self.number.setdefault(w, len(self.number) + 1) for w in words_of(body)), np.int32) for _, body in items]
        lens = np.array([len(p) for p in parts], np.int64)
        self.flat = np.concatenate([np.zeros(0, np.int32), *parts])
        first, size = offsets(lens)[:-1], np.minimum(lens, width)
        many = np.where(lens > 0, lens - size + 1, 0)
        start, owner = ranges(first, many).astype(np.int32), np.repeat(np.arange(len(items), dtype=np.int32), many)
        self.by_length = {int(n): (start[mine], owner[mine]) for n in np.unique(size[lens > 0]) for mine in [size[owner] == n]}
        self.shortest = min(self.by_length, default=0)

    def windows(self, size: int):
        """Windows of a length as rows, a bounded number at a time, with their items."""
        start, owner = self.by_length[size]
        for lo in range(0, len(start), WINDOWS_AT_ONCE):
            yield self.flat[start[lo:lo + WINDOWS_AT_ONCE, None] + np.arange(size)].astype(np.int64), owner[lo:lo + WINDOWS_AT_ONCE]


def search_shard(bodies: list[bytes | None], phrases: Phrases):
    """Per document of a shard: word count, merged hit spans (flat array lo, hi, ...) and the set of items found."""
    words = split_words([b.translate(WORD_BYTES) if b else b for b in bodies])
    counts = np.bincount(words.text, minlength=len(bodies))
    spans, items = [[] for _ in bodies], [set() for _ in bodies]
    if not phrases.by_length or not len(words.number):
        return counts, spans, items
    known = np.fromiter((phrases.number.get(w, 0) for w in words.names.to_pylist()), np.int64, len(words.names))
    ids = np.insert(known[words.number], np.cumsum(counts), 0)  # a 0 behind each document
    del words
    edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False].astype(np.int8)))
    lo, size = edge[::2], edge[1::2] - edge[::2]
    lo, size = lo[size >= phrases.shortest], size[size >= phrases.shortest]
    if not len(lo):
        return counts, spans, items
    at = ranges(lo, size + 1)  # a run and the 0 after it
    index = FMIndex(ids[at], len(phrases.number))
    doc_start = offsets(counts + 1)
    docs, begin, end = [], [], []
    for width in phrases.by_length:
        for rows, owner in phrases.windows(width):
            first, last = index.search(rows)
            hit = np.flatnonzero(last > first)
            where = at[index.locate(ranges(first[hit], (last - first)[hit]))]
            doc = np.searchsorted(doc_start, where, side="right") - 1
            pair = np.unique(doc * len(phrases.ids) + np.repeat(owner[hit], (last - first)[hit]))
            for d, o in zip((pair // len(phrases.ids)).tolist(), (pair % len(phrases.ids)).tolist()):
                items[d].update(() if phrases.ids[o] is None else (phrases.ids[o],))
            docs.append(doc)
            begin.append(where - doc_start[doc])
            end.append(begin[-1] + width)
    docs, begin, end = (np.concatenate(x) for x in (docs, begin, end))
    order = np.argsort(docs, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(docs[order])) + 1):
        if len(part):
            spans[docs[part[0]]] = np.stack(merge_spans(begin[part], end[part]), axis=1).ravel().tolist()
    return counts, spans, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: the id, ``n_words``, ``spans`` (merged [lo, hi) word spans, flat) and ``items``
    (ids, as strings, of the items of which a window of ``width`` words occurs; shorter items are one window)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("binary").alias("b"))
    items = items.where("b is not null")
    total = items.agg(F.sum(F.length("b"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    out = utf8(docs, id_col, text).toDF("id", "body")
    shape = with_fields(out, "id", "body binary, n_words bigint, spans array<bigint>, items array<string>")
    out = out.selectExpr(
        "id", "body", "0L as n_words", "array()::array<bigint> as spans", "array()::array<string> as items")
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "b"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast(Phrases([tuple(r) for r in part.collect()], width))
        last = b == blocks - 1

        def scan(batches, sent=sent, last=last):
            for piece in slices(batches, "body"):
                bodies, _, earlier, items = (c.to_pylist() for c in piece.columns[1:])
                counts, spans, found = search_shard(bodies, sent.value)
                for d, (s, f) in enumerate(zip(earlier, items)):
                    if s:
                        both = np.r_[np.array(s, np.int64), np.array(spans[d], np.int64)].reshape(-1, 2)
                        spans[d] = np.stack(merge_spans(both[:, 0], both[:, 1]), axis=1).ravel().tolist()
                    found[d] = sorted(found[d].union(f))
                body = pa.nulls(piece.num_rows, pa.binary()) if last else piece.column("body")
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), body, pa.array(counts), pa.array(spans, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.string()))], names=["id", "body", "n_words", "spans", "items"])

        out = out.mapInArrow(scan, shape)
        if not last:
            out = written(out, "decontam")
    return out.select(F.col("id").alias(id_col), "n_words", "spans", "items")


def verdicts(found: DataFrame, id_col: str = "doc_id", share: int = 20) -> DataFrame:
    """Counts per document from ``decontaminate``: contaminated when at least one word in ``share`` is hit."""
    hit = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")  # alternating lo, hi: hi_n - (lo_n - (hi_n-1 - ...))
    return found.select(
        id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"))
