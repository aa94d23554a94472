"""Packing of token streams into fixed windows by order-preserving dynamic programming.

Documents are tokenised in the order of the table's rows and laid end to end; the stream is cut into windows
(sequences) of at most ``limit`` tokens. A cut may lie behind a document (free), behind a sentence (``SENTENCE`` tokens of
penalty) or, inside a stretch of more than ``limit / 16`` tokens without either, at every ``limit / 256``-th token
(``INNER``). A window costs its padding: ``limit`` less its tokens, nothing if their number is in ``free`` (lengths that
are stored without padding). The cheapest cuts are found by one pass from left to right: the best start of a window
that ends here is the least ``cost + position`` among the boundaries at most ``limit`` tokens back, which a monotone
queue holds; starts exactly a free length back are looked up beside it. Of equal costs the longer window wins.

No row is shuffled: a task packs its rows in blocks of ``BLOCK_BYTES`` of text, whose windows are chosen together, so
memory is bounded by a block (8 MB of text took 650 MB where every word had five tokens) and the row in hand, and a task that is run again on the same rows gives the same
pieces. A text beyond a block is tokenised and packed in parts cut at white space (its pieces wait for its token
count, 4 bytes a token). Distinct words are tokenised once: the tokeniser drops white space and joins nothing across it.

Defined cases: a null or empty text is the end mark alone; every id, null ones and repeats too, keeps its rows'
pieces apart by ``sequence_id`` and ``offset``; rows are taken in table order, so there are no ties but equal costs
(above); an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import offsets, ranges, slices, with_fields
from vistasieve.llm.words import Words, number_words

BLOCK_BYTES = 8 << 20
SENTENCE, INNER = 16, 64    # penalties, in tokens of padding
MAX_TOKENIZER = 64 << 20    # bytes of a tokeniser file sent to the tasks
MAX_KNOWN = 600_000         # words whose ids a worker remembers
_MARK = "\x01"              # between words that are tokenised together
# words of letters up to U+00FF, or of marks other than the apostrophe
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[!-&(-/:-@\[-`{-~]+")
_SECOND = np.array([re.fullmatch(rb"[\x80-\x96\x98-\xB6\xB8-\xBF]", bytes([b])) is not None for b in range(256)])
_KIND = np.array([next(k for k, p in enumerate((rb"[\x20\x09-\x0D]", rb"[A-Za-z]", rb"[!-&(-/:-@\[-`{-~]", rb"[\s\S]"))
                       if re.fullmatch(p, bytes([b]))) for b in range(256)], np.uint8)  # blank, letter, mark, other
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_STOP = np.isin(np.arange(256), list(b".!?"))


def plain_spec(spec: dict) -> dict:
    """The tokeniser without what lower-case letters up to U+00FF alone, or marks alone, between blanks do not need:
    normalising (none of them is composed of others), and splitting but at blanks."""
    before = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    rest = [step for step in before if step["type"] != "Split"]
    return spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *rest]}}


class WordIds:
    """Token ids of words. Those of up to ``MAX_KNOWN`` words are remembered, over the blocks and tasks of a worker.

    Letters up to U+00FF alone and marks alone need no normalising but lower case.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_str(spec)
        self.plain = Tokenizer.from_str(json.dumps(plain_spec(json.loads(spec))))
        (self.mark,) = self.whole.encode(_MARK, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.known, self.many, self.ids = {b"": 0}, np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def learn(self, tokenizer, words: list[str]) -> None:
        many, ids = [self.many], [self.ids]
        for i in range(0, len(words), 4096):
            texts = [f" {_MARK} ".join(words[j:j + 256] + [""]) for j in range(i, min(i + 4096, len(words)), 256)]
            for coded in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                got = np.array(coded.ids, np.uint32)
                marks = got == self.mark
                many.append(np.diff(np.r_[-1, np.flatnonzero(marks)]) - 1)
                ids.append(got[~marks])
        self.many, self.ids = np.concatenate(many), np.concatenate(ids)

    def __call__(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        if len(self.known) > MAX_KNOWN:
            self.forget()
        new = [w for w in names if w not in self.known]
        plain, other = [], []
        for word in new:
            (plain if _PLAIN.fullmatch(word) else other).append(word)
        for tokenizer, words in ((self.plain, plain), (self.whole, [w for w in other if b"\x01" not in w])):
            self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
            spelt = [w.decode("utf-8", "replace") for w in words]
            self.learn(tokenizer, [w.lower() for w in spelt] if words is plain else spelt)
        for word in other:
            if b"\x01" in word:  # the mark itself is in it
                got = self.whole.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                self.known[word] = len(self.known)
                self.many, self.ids = np.append(self.many, len(got)), np.append(self.ids, np.array(got, np.uint32))
        slot = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        many = self.many[slot]
        return self.ids[ranges(offsets(self.many)[:-1][slot], many)], many


def split_units(bodies: list[bytes]) -> Words:
    """The words of all texts, those of letters up to U+00FF and then marks cut in two: the tokeniser gives the parts the ids
    that they have in the word."""
    body = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    kind = _KIND[body]
    lead = np.flatnonzero(body == 0xC3)
    lead = lead[_SECOND[body[np.minimum(lead + 1, len(body) - 1)]]]
    kind[lead] = kind[lead + 1] = 1  # letters of two bytes
    at = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))  # where bytes of another kind begin, the first word's on
    kind = kind[at]
    before, behind = np.r_[0, kind[:-1]], np.r_[kind[1:], 0]
    cut = (kind == 2) & (before == 1) & (np.r_[0, before[:-1]] == 0) & (behind == 0)
    start, end = at[((kind != 0) & (before == 0)) | cut], at[(kind == 0) | cut]
    text = np.searchsorted(np.cumsum([len(b) + 1 for b in bodies]), start, "right")
    number, names = number_words(body, start, end)
    return Words(number, text, start, end, names, body)


@lru_cache(1)
def word_ids(spec: str) -> WordIds:
    return WordIds(spec)


def best_cuts(at: np.ndarray, penalty: np.ndarray, limit: int, free: Iterable[int]) -> list[int]:
    """Which boundaries (ascending token positions ``at``, the first one 0) end a window in the cheapest packing; the
    last one does. No two neighbours may be more than ``limit`` apart."""
    n = len(at)
    froms, tos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in free:
        i = np.searchsorted(at, at - size)
        hit = np.flatnonzero((at >= size) & (at[np.minimum(i, n - 1)] == at - size))
        froms.append(i[hit])
        tos.append(hit)
    froms, tos = np.concatenate(froms), np.concatenate(tos)
    order = np.lexsort((froms, tos))
    exact, first = froms[order].tolist(), np.searchsorted(tos[order], np.arange(n + 1)).tolist()
    at, penalty = at.tolist(), penalty.tolist()
    total, back, sums, queue = [0] * n, [0] * n, [0] * n, deque([0])  # ``sums`` (total + at) never fall along the queue
    for j in range(1, n):
        here = at[j]
        while at[queue[0]] < here - limit:
            queue.popleft()
        start = queue[0]
        best = sums[start] + limit - here
        if first[j] < first[j + 1]:
            for i in exact[first[j]:first[j + 1]]:
                if total[i] < best or (total[i] == best and i < start):
                    start, best = i, total[i]
        total[j] = best = best + penalty[j]
        back[j], sums[j] = start, best + here
        while queue and sums[queue[-1]] > best + here:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def boundaries(ends: np.ndarray, sentence: np.ndarray, last: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to ``last``, and their penalties: document ends, sentence ends, and
    inner positions where neither comes for long."""
    at, penalty = np.r_[0, last, ends, sentence], np.r_[0, 0, np.zeros(len(ends), np.int64), np.full(len(sentence), SENTENCE)]
    order = np.lexsort((penalty, at))
    at, kept = np.unique(at[order], return_index=True)
    penalty = penalty[order][kept]
    step, wide = max(1, limit // 256), np.flatnonzero(np.diff(at) > max(1, limit // 16))
    many = (at[wide + 1] - at[wide] - 1) // step
    inner = np.repeat(at[wide], many) + step * (1 + ranges(np.zeros(len(wide), np.int64), many))
    at, penalty = np.r_[at, inner], np.r_[penalty, np.full(len(inner), INNER)]
    order = np.argsort(at)
    return at[order], penalty[order]


class _Packer:
    """Packs the rows of one task; ``add`` and ``finish`` yield batches of pieces."""

    def __init__(self, word_ids: WordIds, limit: int, free: tuple[int, ...], end_id: int, id_field: pa.Field, first_sequence: int,
                 block_bytes: int):
        self.word_ids, self.limit, self.free, self.end_id = word_ids, limit, free, end_id
        self.id_field, self.sequence, self.block_bytes = id_field, first_sequence, block_bytes
        self.parts, self.size = [], 0    # (id, bytes, whether its text ends there) of the block in hand
        self.held, self.before = [], 0   # pieces and tokens of a text whose end is still to come

    def add(self, ident, body: bytes) -> Iterator[pa.RecordBatch]:
        start = 0
        while True:
            room = max(1, self.block_bytes - self.size)
            cut = _BLANK.search(body, start + room) if len(body) - start > room else None
            stop = cut.start() if cut else len(body)
            self.parts.append((ident, body[start:stop], cut is None))
            self.size += stop - start + 1
            start = stop
            if self.size >= self.block_bytes:
                yield from self.flush()
            if cut is None:
                return

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        idents, bodies, last = zip(*self.parts)
        self.parts, self.size = [], 0
        last = np.array(last)
        words = split_units(list(bodies))
        # a gap before the next word that holds a line feed ends a sentence, as does a full stop
        feeds = np.r_[0, np.cumsum(words.body == 0x0A)]
        stops = _STOP[words.body[words.end - 1]]
        if len(words.start):
            stops[:-1] |= (feeds[words.start[1:]] > feeds[words.end[:-1]]) & (words.text[1:] == words.text[:-1])
        names = words.names.to_pylist()
        ids, many = self.word_ids(names)
        # one unit a word, and one for the end mark of each text that ends here
        ids, many = np.append(ids, np.uint32(self.end_id)), np.append(many, 1)
        per_part = np.bincount(words.text, minlength=len(bodies))
        behind = np.cumsum(per_part)[last]
        units = np.insert(words.number.astype(np.int64), behind, len(names))
        stops = np.insert(stops, behind, False)
        upto = offsets(many[units])
        flat = ids[ranges(offsets(many)[:-1][units], many[units])]
        part_end = upto[np.cumsum(per_part + last)]
        stops &= ~np.append(units[1:] == len(names), False)  # no cut just before an end mark
        at, penalty = boundaries(part_end[last], upto[1:][stops], len(flat), self.limit)
        ends = at[best_cuts(at, penalty, self.limit, self.free)]
        yield from self.pieces(idents, last, flat, part_end, ends)

    def pieces(self, idents, last, flat, part_end, ends) -> Iterator[pa.RecordBatch]:
        edge = np.unique(np.r_[0, part_end, ends])
        begin, length = edge[:-1], np.diff(edge)
        part = np.searchsorted(part_end, begin, "right")
        tokens = np.diff(np.r_[0, part_end])
        carried = np.zeros(len(tokens), np.int64)
        carried[0] = self.before
        window = np.searchsorted(ends, begin, "right")
        start = begin - (part_end - tokens)[part] + carried[part]
        body = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(4 * edge), pa.py_buffer(flat)])
        batch = pa.RecordBatch.from_arrays(
            [pa.array(idents, self.id_field.type).take(pa.array(part)), pa.array(start), pa.array(length), body.cast(pa.binary()),
             pa.array((tokens + carried)[part]), pa.array(self.sequence + window), pa.array(begin - np.r_[0, ends][window])],
            names=[self.id_field.name, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(ends)
        if self.held and (last[0] or len(last) > 1):
            whole = int(tokens[0]) + self.before
            for old in self.held:
                yield old.set_column(4, "doc_tokens", pa.array(np.full(old.num_rows, whole)))
            self.held = []
        done = len(begin) if last[-1] else int(np.searchsorted(part, len(last) - 1))
        if not last[-1]:
            self.held.append(batch.slice(done))
            self.before = int(tokens[-1] + carried[-1])
        else:
            self.before = 0
        if done:
            yield batch.slice(0, done)


def pack(docs: DataFrame, tokenizer_file: str, limit: int = 2048, free: tuple[int, ...] | None = None, end_id: int = 1,
         id_col: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The pieces of all documents: the id, ``start`` (tokens of its document before it), ``length``, ``ids`` (its token
    ids, 32 bits each, lowest byte first), ``doc_tokens``, ``sequence_id`` and ``offset`` (its place in the sequence).

    ``free`` are the window lengths that need no padding (the powers of two below ``limit``, if not given). The
    tokeniser is a file of the ``tokenizers`` library that drops white space and joins nothing across it.
    """
    free = tuple(1 << k for k in range(limit.bit_length()) if 1 << k < limit) if free is None else free
    spec = Path(tokenizer_file).read_text("utf-8")
    if len(spec) > MAX_TOKENIZER:
        raise ValueError(f"the tokeniser file has more than {MAX_TOKENIZER} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(spec)
    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))

    def run(batches):
        packer = None
        for piece in slices(batches, "body", block_bytes):
            packer = packer or _Packer(word_ids(sent.value), limit, free, end_id, piece.schema.field("key").with_name(id_col),
                                       TaskContext.get().partitionId() << 40, block_bytes)
            for ident, body in zip(*(c.to_pylist() for c in piece.columns)):
                yield from packer.add(ident, body)
        if packer:
            yield from packer.flush()

    more = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(run, with_fields(docs, id_col, more))
