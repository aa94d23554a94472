"""JSON files that hold one array each, read by many tasks.

A file is cut into byte ranges. Whether a bracket or comma counts depends on what comes before: on being inside a string
and on the depth of nesting. So a first pass gives, for each range, the parity of its quotes and how far its brackets
raise the depth, once if it begins outside a string and once inside; running sums over these few rows tell every
range its state at the start (whether a quote is escaped is seen locally, by the backslashes before it). A second
pass cuts the elements: a range owns those whose opening bracket or comma lies in it, and reads on beyond its end to
finish the last one. Both passes read a range in blocks, so a task holds a block and the element in hand, however long
its range. Text that is no single array raises; the elements themselves are parsed by Spark.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistasieve.functions.files import Folder
from vistasieve.operators.rank import materialize

SPLIT_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20  # that a task holds at a time
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_STRUCTURAL = np.isin(np.arange(256), list(b"[]{},"))
_BLANK = np.isin(np.arange(256), list(b" \t\r\n"))
_ELEMENT = "path string, start bigint, n int, element string"


class MalformedArray(ValueError):
    pass


class _File:
    def __init__(self, path: str):
        self.path, self.folder, self.name = path, Folder(os.path.dirname(path)), os.path.basename(path)

    def bytes(self, start: int, length: int) -> bytes:
        return self.folder.read_range(self.name, start, length)

    def first(self) -> tuple[int, bytes]:
        """Position and value of the first byte that is not blank; an empty value if there is none."""
        at = 0
        while block := self.bytes(at, 1 << 16):
            bom = 3 if at == 0 and block.startswith(b"\xef\xbb\xbf") else 0
            rest = block[bom:].lstrip(b" \t\r\n")
            if rest:
                return at + len(block) - len(rest), rest[:1]
            at += len(block)
        return at, b""

    def escaped_at(self, start: int) -> bool:
        """Whether an odd number of backslashes lies directly before ``start``."""
        many, at = 0, start
        while at > 0:
            size = min(at, 256)
            block = self.bytes(at - size, size)
            run = len(block) - len(block.rstrip(b"\\"))
            many, at = many + run, at - size
            if run < size:
                break
        return many % 2 == 1


def _structure(body: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the quotes that open or close strings, and of brackets and commas."""
    raw = np.frombuffer(body, np.uint8)
    at = np.flatnonzero(raw == 0x22)
    slash = np.flatnonzero(raw == 0x5C)
    if len(slash) or escaped:
        # length of the run of backslashes that ends before each quote
        first = np.r_[True, np.diff(slash) > 1] if len(slash) else np.zeros(0, bool)
        begin = slash[first][np.cumsum(first) - 1] if len(slash) else slash
        run = slash - begin + 1 + ((begin == 0) & escaped)
        place = np.searchsorted(slash, at - 1)
        behind = (place < len(slash)) & (slash[np.minimum(place, len(slash) - 1)] == at - 1) if len(slash) else np.zeros(len(at), bool)
        many = np.zeros(len(at), np.int64)
        many[behind] = run[place[behind]]
        many[(at == 0) & escaped] = 1
        at = at[many % 2 == 0]
    return at, np.flatnonzero(_STRUCTURAL[raw])


def _depths(body: bytes, quotes: np.ndarray, marks: np.ndarray, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Brackets and commas outside strings, and the depth behind each of them."""
    marks = marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]
    return marks, depth + np.cumsum(_STEP[np.frombuffer(body, np.uint8)[marks]], dtype=np.int64)


def _escaped_behind(body: bytes, escaped: bool) -> bool:
    """Whether what comes after ``body`` follows an odd number of backslashes."""
    run = len(body) - len(body.rstrip(b"\\"))
    return (run + (escaped and run == len(body))) % 2 == 1


def _summary(path: str, start: int, length: int) -> tuple[int, int, int]:
    """Parity of the quotes of this range, and how far it raises the depth if it begins outside and inside a string."""
    file = _File(path)
    escaped, odd, rise = file.escaped_at(start), False, [0, 0]
    for at in range(start, start + length, BLOCK_BYTES):
        body = file.bytes(at, min(BLOCK_BYTES, start + length - at))
        quotes, marks = _structure(body, escaped)
        for s in (False, True):
            _, depths = _depths(body, quotes, marks, s != odd, 0)
            rise[s] += int(depths[-1]) if len(depths) else 0
        odd ^= len(quotes) % 2 == 1
        escaped = _escaped_behind(body, escaped)
    return int(odd), *rise


def _summaries(batches):
    for batch in batches:
        out = [(*r, *_summary(*r)) for r in zip(*(c.to_pylist() for c in batch.columns))]
        cols = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                         names=["path", "start", "length", "quotes", "outside", "inside"])


def _elements(path: str, start: int, length: int, inside: bool, depth: int) -> Iterator[bytes]:
    """The elements that begin in this range of the file."""
    file = _File(path)
    escaped, at, stop = file.escaped_at(start), start, start + length
    if start == 0 and file.first()[1] != b"[":
        raise MalformedArray(f"{path} is not a JSON array")
    open_, first_open, any_found = None, False, False  # parts so far of the element at the end of what was read
    while at < stop or open_ is not None:
        own = at < stop
        body = file.bytes(at, min(BLOCK_BYTES, stop - at) if own else BLOCK_BYTES)
        if not body:
            raise MalformedArray(f"{path} ends inside its array")
        quotes, marks = _structure(body, escaped)
        marks, depths = _depths(body, quotes, marks, inside, depth)
        raw = np.frombuffer(body, np.uint8)
        kind = raw[marks]
        edge = ((kind == 0x2C) & (depths <= 1)) | ((_STEP[kind] > 0) & (depths == 1)) | ((_STEP[kind] < 0) & (depths <= 0))
        if own:
            # between the arrays' ends only blanks may lie
            low = np.r_[depth, depths] <= 0
            bounds = np.r_[0, marks + 1, len(body)]
            for a, b in zip(bounds[:-1][low].tolist(), bounds[1:][low].tolist()):
                rest = body[a:b].strip(b" \t\r\n").removeprefix(b"\xef\xbb\xbf" if at + a == 0 else b"").strip(b" \t\r\n")
                if rest not in (b"", b"[") or (rest == b"[" and file.first()[0] != at + b - 1):
                    raise MalformedArray(f"{path} holds more than one JSON array")
        begin = 0
        for mark, level, sign in zip(marks[edge].tolist(), depths[edge].tolist(), kind[edge].tolist()):
            if open_ is not None:
                text = (b"".join([*open_, body[begin:mark]]) if open_ else body[begin:mark]).strip(b" \t\r\n")
                if sign in b"}]" and (level < 0 or sign == 0x7D):
                    raise MalformedArray(f"{path}: a bracket at byte {at + mark} closes nothing")
                if text:
                    yield text
                    any_found = True
                elif not (sign == 0x5D and not any_found and first_open):
                    raise MalformedArray(f"{path}: an element before byte {at + mark} is missing")
                open_ = None
            if not own:
                break  # the last own element is complete
            if sign in b"[{,":
                if sign == 0x7B:
                    raise MalformedArray(f"{path} is not a JSON array")
                open_, begin, first_open = [], mark + 1, sign == 0x5B
        if open_ is not None:
            open_.append(body[begin:])
        inside = bool((inside + len(quotes)) % 2)
        depth = int(depths[-1]) if len(depths) else depth
        escaped = _escaped_behind(body, escaped)
        at += len(body)


def _cut(batches):
    for batch in batches:
        for path, start, length, inside, depth in zip(*(c.to_pylist() for c in batch.columns)):
            found, n = _elements(path, start, length, bool(inside), depth), 0
            while part := list(islice(found, 10_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(part)), pa.array(np.full(len(part), start)), pa.array(np.arange(n, n + len(part), dtype=np.int32)),
                     pa.array(part, pa.binary()).cast(pa.string())], names=["path", "start", "n", "element"])
                n += len(part)


def _as_array(batches):
    opened = False
    for batch in batches:
        lines = [("," if opened or i else "[") + text for i, text in enumerate(batch.column(0).to_pylist())]
        opened = opened or bool(lines)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], names=["value"])


def write_array(rows: DataFrame, path: str) -> None:
    """Write the rows as JSON arrays below the folder ``path``: a file for each partition, an element on each line.

    ``read_array`` reads the folder. Null fields are left out, as Spark's JSON writer does; an empty partition gives an
    empty array.
    """
    rows.select(F.to_json(F.struct("*"))).mapInArrow(_as_array, "value string").write.text(path)


def read_array(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path``, ``start``, ``n`` and ``element`` (JSON text) of all array elements, in the order of the first three, which
    is that of the files: ranges are dealt to tasks in order, so rows need no sort."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    ranges = materialize(ranges.select("path", "start", F.least(F.lit(split_bytes), F.col("length") - F.col("start")).alias("length")), "json-ranges")
    width = max(1, min(ranges.count(), 8 * spark.sparkContext.defaultParallelism))
    ranges = ranges.repartition(width, "path", "start")
    found = materialize(ranges.mapInArrow(_summaries, "path string, start bigint, length bigint, quotes bigint, outside bigint, inside bigint"),
                        "json-states")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    states = found.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    states = states.withColumn("rise", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside")))
    states = materialize(states.withColumn("depth", F.coalesce(F.sum("rise").over(before), F.lit(0))), "json-states")
    ends = states.groupBy("path").agg((F.sum("quotes") % 2).alias("q"), F.sum("rise").alias("d")).where("q <> 0 OR d <> 0").take(1)
    if ends:
        raise MalformedArray(f"{ends[0].path} ends inside a string or a bracket")
    cut = states.select("path", "start", "length", "in_string", "depth").repartitionByRange(width, "path", "start")
    cut = cut.sortWithinPartitions("path", "start")  # of ranges, not of elements
    return cut.mapInArrow(_cut, _ELEMENT)
