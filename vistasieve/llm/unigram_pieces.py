"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The vocabulary comes from a SentencePiece model file (its path is a parameter). Blanks become the white-space marker
and one marker is put in front, as the model does; no other normalisation is made, so decoding gives the text back
byte for byte. The best segmentation maximises the sum of the pieces' scores; a character that is no piece by itself
costs the least score minus 10 and becomes its UTF-8 bytes' fallback pieces. Ties go to the path that starts the last
piece earlier. No piece holds a marker behind another character, so the best path of a text is that of its units (a run
of blanks and what follows it); units are encoded once per task and kept in a bounded memo. Units of a batch are searched together, position by position, in
arrays; very long ones by themselves.

A marker character that stands in the text itself is encoded by fallback bytes, so it does not decode to a blank.

Defined cases: a null text has null pieces and decodes to null, an empty text has none and decodes to an empty text;
a very long text is encoded whole, in the task that has it; repeated rows are encoded one by one; an empty table gives an empty result; columns other than the id and the text are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistasieve.llm.common import offsets, ranges, slices, utf8, with_fields

MARK = "▁"
UNKNOWN_COST = 10.0
STRIDE = 4096  # slots tried at once when a node of the double array is placed
MEMO_UNITS = 400_000  # units a task remembers before it starts anew
LONG_UNIT = 100       # bytes; longer units are searched one by one
AT_ONCE = 16_384      # units searched together
_UNITS = re.compile(rb" *[^ ]+| +")


@dataclass
class Vocabulary:
    pieces: list[tuple[bytes, float, int]]  # text with blanks for markers, log score, id
    fallback: list[int]                     # id of each byte's piece
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray                       # index into pieces, or -1

    def surface(self) -> dict[int, bytes]:
        return {i: p for p, _, i in self.pieces} | {i: bytes([b]) for b, i in enumerate(self.fallback)}


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays: the child of state s by byte b is ``base[s] + b + 1`` if its check is s."""
    trie: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for k, key in enumerate(keys):
        node = 0
        for b in key:
            if b not in trie[node]:
                trie[node][b] = len(trie)
                trie.append({})
                ends.append(-1)
            node = trie[node][b]
        ends[node] = k
    size = 2 * len(trie) + 4 * STRIDE
    base, check, value = (np.full(size, x, np.int64) for x in (0, -1, -1))
    open_slots = np.ones(size, bool)
    open_slots[0] = False
    slot, todo, start, taken = {0: 0}, [0], 0, 0
    for node in todo:
        value[slot[node]] = ends[node]
        if not (kids := trie[node]):
            continue
        codes = np.array(sorted(kids)) + 1
        at = start
        while True:
            if at + STRIDE + 257 > len(base):
                more = len(base)
                base, check, value = (np.r_[x, np.full(more, y, np.int64)] for x, y in ((base, 0), (check, -1), (value, -1)))
                open_slots = np.r_[open_slots, np.ones(more, bool)]
            fits = np.logical_and.reduce([open_slots[at + c:at + c + STRIDE] for c in codes])
            if fits.any():
                break
            at += STRIDE
        at += int(fits.argmax())
        base[slot[node]], check[at + codes] = at, slot[node]
        open_slots[at + codes] = False
        taken += len(codes)
        if taken > STRIDE:  # leave behind what is nearly full
            start, taken = start + STRIDE * (np.count_nonzero(open_slots[start:start + STRIDE]) < STRIDE // 20), 0
        for b, kid in kids.items():
            slot[kid] = at + b + 1
            todo.append(kid)
    return base, check, value


def load_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    fallback, pieces = {}, []
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            fallback[int(text[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces.append((text.replace(MARK, " ").encode(), sp.get_score(i), i))
    if len(fallback) != 256:
        raise ValueError(f"{model_file} has {len(fallback)} byte pieces; fallback needs all 256")
    if any(b" " in p.lstrip(b" ") for p, _, _ in pieces):
        raise ValueError(f"{model_file} has pieces with a marker behind another character")
    return Vocabulary(pieces, [fallback[b] for b in range(256)], *double_array([p for p, _, _ in pieces]))


class Viterbi:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.base, self.check, self.value = vocab.base.tolist(), vocab.check.tolist(), vocab.value.tolist()
        self.scores, self.ids = [s for _, s, _ in vocab.pieces], [i for _, _, i in vocab.pieces]
        self.unknown = min(self.scores) - UNKNOWN_COST
        self.fallback = vocab.fallback
        self.memo: dict[bytes, bytes] = {}

    def edges(self, text: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every piece found from every position, all positions descending the trie
        together; ``stop`` is the end of each position's unit. Characters that are no piece get an edge of piece -1."""
        base, check, value = self.vocab.base, self.vocab.check, self.vocab.value
        width = np.select([text < 0xC0, text < 0xE0, text < 0xF0], [1, 2, 3], 4)
        width = np.minimum(width, stop - np.arange(len(text)))
        lone = np.ones(len(text), bool)
        at, state, depth, out = np.arange(len(text)), np.zeros(len(text), np.int64), 0, []
        while at.size:
            nxt = np.minimum(base[state] + text[at + depth] + 1, len(check) - 1)
            live = check[nxt] == state
            at, state, depth = at[live], nxt[live], depth + 1
            piece = value[state]
            hit = piece >= 0
            out.append((at[hit], np.full(np.count_nonzero(hit), depth), piece[hit]))
            lone[at[hit][width[at[hit]] == depth]] = False
            more = at + depth < stop[at]
            at, state = at[more], state[more]
        rest = np.flatnonzero(lone)
        out.append((rest, width[rest], np.full(len(rest), -1)))
        return tuple(np.concatenate(c) for c in zip(*out))

    def best_paths(self, units: list[bytes]) -> list[bytes]:
        """``best_path`` of many units at once, each as the bytes of 32-bit ids: positions advance together."""
        sizes = np.array([len(u) for u in units], np.int64)
        text = np.frombuffer(b"".join(units), np.uint8).astype(np.int64)
        begin = offsets(sizes)
        unit = np.repeat(np.arange(len(units)), sizes)
        start, length, piece = self.edges(text, begin[1:][unit])
        step = (start - begin[unit[start]]) * (1 + int(length.max())) + length  # by place in the unit, then by length
        order = np.argsort(step.astype(np.uint16) if step.max() < 1 << 16 else step, kind="stable")
        start, length, piece, step = start[order], length[order], piece[order], step[order]
        gain = np.where(piece >= 0, np.array(self.scores)[piece], self.unknown)
        source = start + unit[start]  # one node more than positions in each unit
        target = source + length
        n = len(text) + len(units)
        best, came, by = np.full(n, -np.inf), np.zeros(n, np.int64), np.full(n, -1)
        best[begin[:-1] + np.arange(len(units))] = 0.0
        cuts = np.r_[np.flatnonzero(np.diff(step, prepend=-1)), len(step)].tolist()
        for lo, hi in zip(cuts, cuts[1:]):
            total = best[source[lo:hi]] + gain[lo:hi]
            better = np.flatnonzero(total > best[target[lo:hi]]) + lo
            best[target[better]], came[target[better]], by[target[better]] = total[better - lo], source[better], piece[better]
        node, who, steps = begin[1:] + np.arange(len(units)), np.arange(len(units)), []
        first = begin[:-1] + np.arange(len(units))
        while who.size:
            steps.append((who, node, came[node], by[node]))
            node = came[node]
            go = node > first[who]
            who, node = who[go], node[go]
        who, node, back, piece = (np.concatenate(c) for c in zip(*steps[::-1]))
        order = np.argsort(who, kind="stable")  # within a unit from the first piece to the last
        who, node, back, piece = who[order], node[order], back[order], piece[order]
        count = np.where(piece >= 0, 1, node - back)
        ids = np.repeat(np.array(self.ids)[piece], count)
        lost = np.repeat(piece < 0, count)
        ids[lost] = np.array(self.fallback)[text[(ranges(back, count) - np.repeat(who, count))[lost]]]
        ends = (4 * np.cumsum(np.bincount(who, count, minlength=len(units)).astype(np.int64))).tolist()
        flat = ids.astype(np.int32).tobytes()
        return [flat[x:y] for x, y in zip([0, *ends], ends)]

    def best_path(self, unit: bytes) -> list[int]:
        """Piece ids of the best segmentation of a unit (blanks stand for markers)."""
        base, check, value, scores = self.base, self.check, self.value, self.scores
        n, top = len(unit), len(check)
        best, start, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            so_far = best[s]
            if so_far is None:
                continue
            lead = unit[s]
            width = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single, state = False, 0
            for e in range(s, n):
                nxt = base[state] + unit[e] + 1
                if nxt >= top or check[nxt] != state:
                    break
                state = nxt
                k = value[state]
                if k >= 0:
                    single = single or e + 1 - s == width
                    total = so_far + scores[k]
                    if best[e + 1] is None or total > best[e + 1]:
                        best[e + 1], start[e + 1], piece[e + 1] = total, s, k
            e = min(n, s + width)
            if not single and (best[e] is None or so_far + self.unknown > best[e]):
                best[e], start[e], piece[e] = so_far + self.unknown, s, -1
        out, e = [], n
        while e:
            s, k = start[e], piece[e]
            out += [self.ids[k]] if k >= 0 else [self.fallback[b] for b in reversed(unit[s:e])]
            e = s
        return out[::-1]

    def learn(self, units: set[bytes]) -> None:
        """Put the paths of units that the memo lacks into it."""
        if len(self.memo) > MEMO_UNITS:
            self.memo.clear()
        new = units.difference(self.memo)
        for u in [u for u in new if len(u) > LONG_UNIT]:
            self.memo[u] = np.array(self.best_path(b" " + u), np.int32).tobytes()
        short = [u for u in new if len(u) <= LONG_UNIT]
        for at in range(0, len(short), AT_ONCE):
            part = short[at:at + AT_ONCE]
            self.memo.update(zip(part, self.best_paths([b" " + u for u in part])))

    def encode_all(self, bodies: list[bytes | None]) -> list[bytes | None]:
        """Piece ids of each text, as the bytes of 32-bit numbers."""
        split = [None if b is None else units_of(b) for b in bodies]
        self.learn(set().union(*(u for u in split if u)))
        return [None if u is None else b"".join(map(self.memo.__getitem__, u)) for u in split]

    def encode(self, body: bytes) -> np.ndarray:
        return np.frombuffer(self.encode_all([body])[0], np.int32)


def units_of(body: bytes) -> list[bytes]:
    """The units of a text, without the marker that each begins with."""
    if not body:
        return []
    if body[0] != 32 and b"  " not in body:
        return body.split(b" ")
    return [u[1:] for u in _UNITS.findall(b" " + body)]


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``ids`` (piece ids) and ``n_fallback`` (how many are fallback bytes)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        viterbi, byte_piece = Viterbi(sent.value), np.zeros(1 + max(sent.value.surface()), bool)
        byte_piece[sent.value.fallback] = True
        for piece in slices(batches, "body", 2 << 20):
            coded = viterbi.encode_all(piece.column(1).to_pylist())
            ids = np.frombuffer(b"".join(c for c in coded if c), np.int32)
            at = offsets(np.array([len(c or b"") // 4 for c in coded], np.int64))
            fallback = offsets(byte_piece[ids])
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids),
                                             mask=pa.array([c is None for c in coded]))
            yield pa.RecordBatch.from_arrays([piece.column(0), lists, pa.array(np.diff(fallback[at]))],
                                             names=[id_col, "ids", "n_fallback"])

    return utf8(docs, id_col, text).mapInArrow(run, with_fields(docs, id_col, "ids array<int>, n_fallback bigint"))


def decode(encoded: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", ids: str = "ids",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: the id, the columns ``keep`` and ``decoded``, the text that the pieces stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocab.surface())
    src = encoded.select(id_col, *keep, F.col(ids).alias("_ids"))

    def run(batches):
        surface = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(part.num_columns - 1)
                pieces = list(map(surface.__getitem__, lists.flatten().to_numpy().tolist()))
                ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).tolist()
                texts = [b"".join(pieces[x:y])[1:] if good else None
                         for x, y, good in zip([0, *ends], ends, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.binary()).cast(pa.string())],
                                                 names=[id_col, *keep, "decoded"])

    return src.mapInArrow(run, T.StructType([*src.schema[:-1], T.StructField("decoded", T.StringType())]))
