"""Language-model scoring with Elias-Fano n-gram tries.

The model is an interpolated trigram model over lower-cased words with begin and end marks:

    p1(w)      = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p2(w | a)  = (c(a w) + KAPPA p1(w)) / (c(a) + KAPPA)
    p3(w | ab) = q(c(a b w) / (c(a b) + T(a b))) + q(T(a b) / (c(a b) + T(a b))) p2(w | b)     (p2 where "a b" was never learned)

T(a b) is the number of distinct words learned behind "a b" (Witten and Bell's smoothing), so what a context stores
follows from its own counts. ``q`` rounds a logarithm to a fixed grid of eighths of a power of two, 8 bits wide: an error
of at most 4.5 % at any size, halves exact, values below 2^-31.75 raised to it. No number depends on how many blocks,
shards or partitions there are, or on the size of the table.

Counting and scoring go through blocks and shards (see ``exchange``): a shard owns the words and the bigrams that hash
to it, with all trigrams that extend them. It builds a trie of two levels below its contexts: sorted bigram keys, the
monotone pointers to each one's successors, and the successors' 32-bit codes, made monotone by their context's rank.
All three are Elias-Fano sequences (packed low bits, unary high bits with select directories); smoothed trigram
probabilities and back-off weights lie beside them as 8-bit codes of the grid, bigram counts as bytes, with those of
``LARGE`` or more in a list of their own, so that they are exact (p2 needs the count of its first word, which another
shard owns, and is smoothed where the answers meet). The level file is written to the shared folder, mapped into memory
(read whole where the store is no file system), queried by successor search relative to the context, and deleted
unless ``keep`` names a folder for it.

What a task holds is bounded by block and shard sizes; the number of shards grows with the text. Words and contexts are
named by hashes (64 bits choose the shard, 56 tell contexts apart in it), successors by 32-bit hashes in their context.

Defined cases: null and empty texts have the end as their only token; a row with a null id is learned from unless
``learn`` says otherwise; repeated rows are learned from and scored one by one; a very long
text is a block by itself, in about 17 times its size; equal n-grams are one; if nothing is learned all counts are
0; an empty table gives an empty result; columns other than the id, the text and those in ``learn`` are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistasieve.functions.files import Folder
from vistasieve.llm import exchange
from vistasieve.llm.common import offsets, ranges
from vistasieve.session import scratch_path

KAPPA = 2000.0
BLOCK_BYTES = 7 << 20
KEY_BITS = 56           # of a context's hash within its shard
SHARD_BYTES = 8 << 20  # of text, on average
AT_ONCE = 1 << 18      # lookups made together
LARGE = 255            # counts from here on have a list
BEGIN, END = 0, 1  # local numbers; words follow
_MARKS = (0x243F6A8885A308D3, 0x13198A2E03707344)  # their hashes
_MULT = np.uint64(0x9E3779B97F4A7C15)
_CODE = np.uint64((1 << 32) - 1)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Position of the k-th one (or zero, if ``flip``) of a packed bit vector."""
    at = np.searchsorted(before, k, side="right") - 1
    word = ~words[at] if flip else words[at]
    rest, out = (k - before[at]).astype(np.int64), at * 64
    for width in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        up = rest >= ones
        rest -= np.where(up, ones, 0)
        word = np.where(up, word >> np.uint64(width), word)
        out += np.where(up, width, 0)
    return out


class EliasFano:
    """A non-decreasing sequence below ``universe``: low bits packed, high bits in unary with select directories."""

    FIELDS = ("head", "low", "high", "ones", "zeros")

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = arrays
        head, self.low, self.high, self.ones, self.zeros = arrays
        self.n, self.width = int(head[0]), int(head[1])

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (max(universe, 1) - 1).bit_length() - max(n, 1).bit_length())
        values = values.astype(np.uint64)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            bit = np.arange(n, dtype=np.int64) * width
            part = values & np.uint64((1 << width) - 1)
            shift = (bit & 63).astype(np.uint64)
            np.bitwise_or.at(low, bit >> 6, part << shift)
            over = np.flatnonzero((bit & 63) + width > 64)
            np.bitwise_or.at(low, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
        top = (values >> np.uint64(width)).astype(np.int64)
        size = n + ((max(universe, 1) - 1) >> width) + 2
        bits = np.zeros(-(-size // 64) * 64, bool)
        bits[top + np.arange(n)] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = offsets(np.bitwise_count(high))[:-1]
        return cls([np.array([n, width], np.int64), low, high, ones, np.arange(len(high), dtype=np.int64) * 64 - ones])

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        bit = i * self.width
        at, shift = bit >> 6, (bit & 63).astype(np.uint64)
        upper = np.where(shift > 0, self.low[at + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (self.low[at] >> shift | upper) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        if len(i) > AT_ONCE:
            return np.concatenate([self.get(i[k:k + AT_ONCE]) for k in range(0, len(i), AT_ONCE)])
        top = _select(self.high, self.ones, i, False) - i
        return top.astype(np.uint64) << np.uint64(self.width) | self.low_bits(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element that is at least ``x``, and whether it equals ``x``."""
        if len(x) > AT_ONCE:
            parts = [self.successor(x[i:i + AT_ONCE]) for i in range(0, len(x), AT_ONCE)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        top = (x >> np.uint64(self.width)).astype(np.int64)
        low = x & np.uint64((1 << self.width) - 1)
        lo = np.zeros(len(x), np.int64)
        some = np.flatnonzero(top)
        lo[some] = _select(self.high, self.zeros, top[some] - 1, True) - (top[some] - 1)
        end = _select(self.high, self.zeros, top, True) - top
        hi = end.copy()
        open_ = np.flatnonzero(lo < hi)
        while open_.size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.low_bits(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        found = lo < end
        some = np.flatnonzero(found)
        found[some] = self.low_bits(lo[some]) == low[some]
        return lo, found


GRID = np.log10(2) / 8  # between neighbouring values, as logarithms


def quantise(values: np.ndarray) -> np.ndarray:
    """8-bit codes (from 1; 0 is for "absent") of probabilities."""
    with np.errstate(divide="ignore"):
        return (np.clip(np.rint(-np.log10(values) / GRID), 0, 254) + 1).astype(np.uint8)


#: The value of each code, "absent" first.
GRID_VALUES = np.r_[0.0, 10 ** (-GRID * np.arange(255))]


class Trie:
    """Levels of a shard: contexts, pointers and successors, with codes; serialised as one file."""

    PARTS = 3 * len(EliasFano.FIELDS) + 5

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = arrays
        self.contexts, self.pointers, self.successors = (EliasFano(arrays[i:i + 5]) for i in (0, 5, 10))
        self.counts, self.large, self.large_count, self.backoff, self.prob = arrays[15:]

    @classmethod
    def build(cls, key: np.ndarray, count: np.ndarray, children: np.ndarray, code: np.ndarray, freq: np.ndarray) -> Trie:
        """Sorted context keys with their counts and numbers of successors; successors' codes (sorted) and counts."""
        rank = np.repeat(np.arange(len(key), dtype=np.uint64), children)
        large = np.flatnonzero(count >= LARGE)
        kinds = np.maximum(children, 1)  # no word follows a mark of the end
        backoff = quantise(kinds / (count + kinds))
        prob = quantise(freq / np.repeat(count + kinds, children))
        return cls([*EliasFano.encode(key, 1 << KEY_BITS).arrays, *EliasFano.encode(offsets(children), len(code) + 1).arrays,
                    *EliasFano.encode(rank << np.uint64(32) | code, max(1, len(key)) << 32).arrays,
                    np.minimum(count, LARGE).astype(np.uint8), large, count[large], backoff, prob])

    def dump(self) -> bytes:
        """Header of kinds and sizes, then the arrays, each at a multiple of eight bytes."""
        kinds = [np.dtype(x).num for x in (np.uint8, np.int64, np.uint64, np.float64)]
        head = np.array([(kinds.index(a.dtype.num), len(a)) for a in self.arrays], np.int64)
        return head.tobytes() + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in self.arrays)

    @classmethod
    def load(cls, raw: np.ndarray) -> Trie:
        head, at, arrays = raw[:16 * cls.PARTS].view(np.int64).reshape(-1, 2), 16 * cls.PARTS, []
        for kind, n in head.tolist():
            dtype = np.dtype((np.uint8, np.int64, np.uint64, np.float64)[kind])
            arrays.append(raw[at:at + n * dtype.itemsize].view(dtype))
            at += -(-n * dtype.itemsize // 8) * 8
        return cls(arrays)

    def lookup(self, key: np.ndarray, children: np.ndarray, code: np.ndarray):
        """Contexts' counts (0: absent), and codes (0: absent) of their back-off weights and successors' probabilities."""
        if not self.contexts.n:
            return np.zeros(len(key), np.int64), np.zeros(len(key), np.uint8), np.zeros(len(code), np.uint8)
        rank, known = self.contexts.successor(key)
        rank = np.where(known, rank, 0)
        counts = np.where(known, self.counts[rank], 0).astype(np.int64)
        more = np.flatnonzero(counts == LARGE)
        counts[more] = self.large_count[np.searchsorted(self.large, rank[more])]
        backoff = np.where(known, self.backoff[rank], 0).astype(np.uint8)
        prob = np.zeros(len(code), np.uint8)
        start, stop = self.pointers.get(rank).astype(np.int64), self.pointers.get(rank + 1).astype(np.int64)
        owner = np.repeat(np.arange(len(key)), children)
        ask = np.flatnonzero((known & (stop > start))[owner])
        if ask.size:
            owner = owner[ask]
            at, found = self.successors.successor(rank[owner].astype(np.uint64) << np.uint64(32) | code[ask])
            found &= (at >= start[owner]) & (at < stop[owner])
            prob[ask[found]] = self.prob[at[found]]
        return counts, backoff, prob


def load_levels(folder: Folder, name: str) -> np.ndarray:
    if folder.local:
        return np.memmap(f"{folder.root}/{name}", np.uint8, "r")
    with folder.read(name) as f:
        return np.frombuffer(f.read(), np.uint8)


def shuffled(x: np.ndarray) -> bytes:
    """The bytes of an array by significance, which compresses better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() if len(x) else b""


def unshuffled(data, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Block:
    """Tokens of a block's documents and their distinct words, bigrams and trigrams, ordered by shard and key."""

    def __init__(self, payload: bytes, shards: int):
        ids, null, learn, lens, words, text = exchange.unpack(payload)
        self.ids, self.null, self.learn = (np.frombuffer(x, t) for x, t in ((ids, np.int64), (null, bool), (learn, bool)))
        self.lens = np.frombuffer(lens, np.int64)
        self.words = bytes(text).split(b" ") if len(text) else []
        local = unshuffled(words, np.int32)
        at = offsets(self.lens + 2)  # begin, words, end
        seq = np.empty(at[-1], np.int64)
        seq[at[:-1]], seq[at[1:] - 1] = BEGIN, END
        seq[ranges(at[:-1] + 1, self.lens)] = local
        self.seq, self.at = seq, at
        self.kinds = len(self.words) + 2
        h = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        hashes = np.r_[np.array(_MARKS, np.uint64), h]
        self.token_learn = np.repeat(self.learn, self.lens + 2)
        self.word_count = np.bincount(seq[self.token_learn], minlength=self.kinds)[2:]
        self.word_shard = (h % np.uint64(shards)).astype(np.int64)
        self.word_order = np.argsort(self.word_shard, kind="stable")
        second = np.ones(len(seq), bool)
        second[at[:-1]] = False
        third = second.copy()
        third[at[:-1] + 1] = False
        self.second, self.third = np.flatnonzero(second), np.flatnonzero(third)
        pair, number = np.unique(seq[self.second - 1] * self.kinds + seq[self.second], return_inverse=True)
        a, b = hashes[pair // self.kinds], hashes[pair % self.kinds]
        key = (a ^ (b * _MULT + (a << np.uint64(7)))) * _MULT
        key ^= key >> np.uint64(31)
        shard = (key % np.uint64(shards)).astype(np.int64)
        key >>= np.uint64(64 - KEY_BITS)
        order = np.lexsort((key, shard))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.key, self.key_shard, self.pair_of = key[order], shard[order], place[number]
        context = np.zeros(len(seq), np.int64)
        context[self.second] = self.pair_of
        code = (hashes * _MULT) >> np.uint64(32)
        triple, self.triple_of = np.unique(context[self.third - 1] * self.kinds + seq[self.third], return_inverse=True)
        self.triple_context, self.code = triple // self.kinds, code[triple % self.kinds].astype(np.uint32)
        order = np.lexsort((self.code, self.triple_context))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.triple_context, self.code, self.triple_of = self.triple_context[order], self.code[order], place[self.triple_of]
        self.shards = shards

    def parts(self):
        """Per shard with a question: its words, bigrams and trigrams (as ranges of the ordered ones)."""
        every = np.arange(self.shards + 1)
        words = np.searchsorted(self.word_shard[self.word_order], every)
        pairs = np.searchsorted(self.key_shard, every)
        triples = np.searchsorted(self.triple_context, pairs)
        for s in range(self.shards):
            if words[s] < words[s + 1] or pairs[s] < pairs[s + 1]:
                yield s, *(slice(x[s], x[s + 1]) for x in (words, pairs, triples))

    def ask(self) -> list[tuple[int, bytes]]:
        pair_count = np.bincount(self.pair_of[self.token_learn[self.second]], minlength=len(self.key))
        count = np.bincount(self.triple_of[self.token_learn[self.third]], minlength=len(self.code))
        out = []
        for s, w, p, t in self.parts():
            order = self.word_order[w]
            delta = np.diff(self.key[p], prepend=np.uint64(0))
            kids = np.bincount(self.triple_context[t] - p.start, minlength=p.stop - p.start)
            out.append((s, exchange.pack(
                b" ".join(map(self.words.__getitem__, order.tolist())), shuffled(self.word_count[order].astype(np.int64)),
                shuffled(delta), shuffled(pair_count[p].astype(np.int32)), shuffled(kids.astype(np.int32)),
                self.code[t], shuffled(count[t].astype(np.int32)))))
        return out

    def score(self, answers: list[bytes], tokens: int, kinds: int, learned: int):
        """Per document: base score, model score, known tokens."""
        count = np.zeros(self.kinds)
        count[END] = learned
        pair = np.zeros(len(self.key))
        backoff, prob = np.zeros(len(self.key)), np.zeros(len(self.code))
        for (_, w, p, t), got in zip(self.parts(), answers, strict=True):
            words, c, b, q = exchange.unpack(got)
            count[2 + self.word_order[w]] = unshuffled(words, np.int64)
            pair[p] = unshuffled(c, np.int64)
            backoff[p], prob[t] = (GRID_VALUES[np.frombuffer(x, np.uint8)] for x in (b, q))
        backoff[pair == 0] = 1.0  # never learned: the whole weight is p2's
        p1 = (count + 0.5) / (tokens + 0.5 * (kinds + 1))
        known = np.r_[0, np.cumsum(count[self.seq[self.second]] > 0)]
        context = count.copy()
        context[BEGIN], context[END] = learned, 0
        a, b = self.seq[self.second - 1], self.seq[self.second]
        p = (pair[self.pair_of] + KAPPA * p1[b]) / (context[a] + KAPPA)
        full = np.zeros(len(self.seq))
        full[self.second] = p
        ctx = np.zeros(len(self.seq), np.int64)
        ctx[self.second] = self.pair_of
        full[self.third] = prob[self.triple_of] + backoff[ctx[self.third - 1]] * full[self.third]
        at = offsets(self.lens + 1)
        sums = [np.add.reduceat(np.log10(x), at[:-1]) if len(at) > 1 else np.zeros(0) for x in (p1[b], full[self.second])]
        return (*sums, np.diff(known[at]))


def answer_shard(questions: list[bytes], folder: str, keep: bool) -> tuple[list[bytes], list[int]]:
    """Add up the counts of all blocks, build the shard's trie, and look up what each block asked; also the shard's
    learned words and how many are distinct."""
    asked, words, sizes = [], {}, []
    for q in questions:
        text, word_count, delta, pair_count, kids, code, count = exchange.unpack(q)
        own = bytes(text).split(b" ") if len(text) else []
        for w, c in zip(own, unshuffled(word_count, np.int64).tolist()):
            words[w] = words.get(w, 0) + c
        asked.append((np.cumsum(unshuffled(delta, np.uint64), dtype=np.uint64), unshuffled(pair_count, np.int32),
                      unshuffled(kids, np.int32), np.frombuffer(code, np.uint32), unshuffled(count, np.int32)))
        sizes.append((own, len(asked[-1][0]), len(asked[-1][3])))
    keys, pair_count, kids, code, triple_count = (np.concatenate(c) for c in zip(*asked))
    del asked, questions
    key, pair_of = np.unique(keys, return_inverse=True)
    count = np.bincount(pair_of, pair_count, minlength=len(key)).astype(np.int64)
    keys = np.repeat(pair_of, kids).astype(np.uint64) << np.uint64(32) | code
    triple, triple_of = np.unique(keys, return_inverse=True)
    freq = np.bincount(triple_of, triple_count, minlength=len(triple)).astype(np.int64)
    pair_of, triple_of = pair_of.astype(np.int32), triple_of.astype(np.int32)
    del keys, pair_count, kids, code, triple_count
    context, code = (triple >> np.uint64(32)).astype(np.int64), triple & _CODE
    learned, kept = count > 0, freq > 0
    kids = np.bincount(context[kept], minlength=len(key))[learned]
    trie = Trie.build(key[learned], count[learned], kids, code[kept], freq[kept])
    name, store = f"trie-{uuid.uuid4().hex}.levels", Folder(folder)
    with store.write(name) as f:
        f.write(trie.dump())
    del trie
    levels = Trie.load(load_levels(store, name))
    codes = levels.lookup(key, np.bincount(context, minlength=len(key)), code)
    del levels
    if not keep:
        store.delete([name])
    out, pairs, triples = [], 0, 0
    for own, n_pairs, n_triples in sizes:
        p, t = pair_of[pairs:pairs + n_pairs], triple_of[triples:triples + n_triples]
        pairs, triples = pairs + n_pairs, triples + n_triples
        out.append(exchange.pack(shuffled(np.array([words[w] for w in own], np.int64)), shuffled(codes[0][p]),
                                 codes[1][p], codes[2][t]))
    return out, [sum(words.values()), sum(1 for c in words.values() if c)]


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """One row per document: the id, ``learned``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    shards = exchange.shards_for(docs, text, SHARD_BYTES)
    folder = keep or scratch_path(spark, "ngram-tries")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("body"),
                       F.coalesce(learn, F.lit(True)).alias("learn"))

    def build(ids, bodies, learns):
        number: dict[bytes, int] = {}
        local, lens = [], []
        for body in bodies:
            words = body.lower().split() if body else []
            for w in set(words).difference(number):
                number[w] = len(number) + 2
            local.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            lens.append(len(words))
        return exchange.pack(np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]),
                             np.array(learns, bool), np.array(lens, np.int64), shuffled(np.concatenate(local)), b" ".join(number))

    blocks = exchange.make_blocks(rows, build, BLOCK_BYTES)
    asked = exchange.questions(blocks, None, lambda payload, _: Block(payload, shards).ask())
    answers = exchange.answer(asked, lambda q: answer_shard(q, folder, keep is not None), "ngram-answers", shards)
    total = answers.agg(F.sum(F.col("totals")[0]), F.sum(F.col("totals")[1])).first()
    learned = rows.where("learn").count()
    tokens, kinds = (total[0] or 0) + learned, (total[1] or 0) + (learned > 0)

    def score(_, payload, got):
        block = Block(payload, shards)
        base, model, known = block.score(got, tokens, kinds, learned)
        n = len(block.ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids, mask=block.null), pa.array(block.learn), pa.array(block.lens + 1), pa.array(known),
             pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(model)],
            names=["id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = exchange.by_block(blocks, answers, score, "id bigint, learned boolean, n_tokens bigint, n_known bigint, "
                            "train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
