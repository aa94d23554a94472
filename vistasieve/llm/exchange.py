"""Blocks and shards: how tasks look things up in a table that no task could hold.

Documents are packed into blocks of bounded size, written once. A block asks each shard (a hash range of the keys) one
packed question; a shard sees the questions of all blocks, and only what hashes to it; its packed answers go back by
block. Two shuffles of compact byte strings replace a row for every key. Shard and block sizes are bounded by their
number, which grows with the input; a key that many documents share costs one entry per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import partitions_for, slices, written

ROW = "block bigint, shard int, payload binary"
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20  # of text per shard, on average


def pack(*parts) -> bytes:
    """Byte strings and arrays as one compressed byte string."""
    parts = [p.tobytes() if isinstance(p, np.ndarray) else p for p in parts]
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    body = b"".join(parts)
    return head + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def unpack(data: bytes) -> list[memoryview]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    lens = np.frombuffer(data, np.int64, n, 8)
    body = memoryview(pa.decompress(data[8 * n + 8:], int(lens.sum()), codec="zstd") if lens.any() else b"")
    at = np.r_[0, np.cumsum(lens)].tolist()
    return [body[a:b] for a, b in zip(at, at[1:])]


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [(), (), ()]
    return pa.table({k: pa.array(c, t) for (k, t), c in zip((("block", pa.int64()), ("shard", pa.int32()),
                                                             ("payload", pa.binary())), cols)})


def make_blocks(rows: DataFrame, build: Callable[..., bytes], max_bytes: int | None = None) -> DataFrame:
    """Written table of blocks (shard -1); ``build`` packs the columns of a block's rows, ``body`` among them."""
    limit = max_bytes or BLOCK_BYTES

    def run(batches):
        for piece in slices(batches, "body", limit):
            packed = build(*(c.to_pylist() for c in piece.columns))
            yield from _rows([(uuid.uuid4().int >> 65, -1, packed)]).to_batches()

    return written(rows.mapInArrow(run, ROW), "blocks")


def shards_for(docs: DataFrame, text: str, shard_bytes: int | None = None) -> int:
    size = docs.agg(F.sum(F.length(F.col(text).cast("binary")))).first()[0] or 0
    return max(partitions_for(docs.sparkSession), 1 + size // (shard_bytes or SHARD_BYTES))


def by_block(blocks: DataFrame, answers: DataFrame | None, work: Callable[..., Iterator[pa.RecordBatch]], shape: str) -> DataFrame:
    """``work(block, payload, answers)`` for each block, its answers in the order of their shards."""
    if answers is None:
        def alone(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield from work(row["block"], row["payload"], [])
        return blocks.mapInArrow(alone, shape)

    def together(part: pa.Table) -> pa.Table:
        rows = sorted(zip(part.column("shard").to_pylist(), part.column("payload").to_pylist()), key=lambda r: r[0])
        return pa.Table.from_batches(list(work(part.column("block")[0].as_py(), rows[0][1], [p for _, p in rows[1:]])))

    return blocks.unionByName(answers.drop("totals")).groupBy("block").applyInArrow(together, shape)


def questions(blocks: DataFrame, answers: DataFrame | None, ask: Callable[..., list[tuple[int, bytes]]]) -> DataFrame:
    """``ask(payload, answers)`` gives a block's (shard, question) pairs, in ascending order of shards."""
    def work(block, payload, got):
        rows = _rows([(block, s, q) for s, q in ask(payload, got)])
        yield pa.RecordBatch.from_arrays([c.combine_chunks() for c in rows.columns], schema=rows.schema)

    return by_block(blocks, answers, work, ROW)


def answer(asked: DataFrame, reply: Callable[[list[bytes]], tuple[list[bytes], list[int]]], name: str, shards: int) -> DataFrame:
    """``reply(questions)`` answers all questions put to a shard and adds totals of the shard. The written answers
    carry block and shard, and ``totals`` once for each shard (else null). Every shard is a partition of its own."""
    def work(part: pa.Table) -> pa.Table:
        order = np.argsort(part.column("block").to_numpy(), kind="stable")  # the same order however rows arrive
        part = part.take(pa.array(order))
        got, totals = reply(part.column("payload").to_pylist())
        return pa.table({"block": part.column("block"), "shard": part.column("shard"), "payload": pa.array(got, pa.binary()),
                         "totals": pa.array([totals] + [None] * (len(got) - 1), pa.list_(pa.int64()))})

    def run(batches):
        part = pa.Table.from_batches([*batches], _rows([]).schema)
        for shard in pa.compute.unique(part.column("shard")).to_pylist():
            yield from work(part.filter(pa.compute.equal(part.column("shard"), shard))).to_batches()

    return written(asked.repartitionById(shards, "shard").mapInArrow(run, f"{ROW}, totals array<bigint>"), name)
