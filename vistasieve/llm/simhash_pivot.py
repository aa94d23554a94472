"""SimHash near-duplicates with pivot distance tables.

Fingerprints: 64 majority bits over the XXH64 values of all word shingles. Equal fingerprints collapse first. Two
fingerprints within ``max_bits`` bits agree on a whole part of any split into ``max_bits + 1`` parts, and again on a
whole part of what remains, so each distinct fingerprint goes to one group per (part, sub-part): exact, no pair is
lost. A group that is still too large is split further the same way, down to at most 2^10 values. Inside a group the
rows carry their Hamming distances to many reference fingerprints; sorted by the first distance, pairs are discarded
by the largest difference of any coordinate (the triangle inequality), and the survivors are verified on the
fingerprints. Groups give star-shaped links, never all pairs; components come from alternating large-star and
small-star joins over written tables.

Defined cases: null and wordless texts have fingerprint zero and link like any other; a row with a null id is returned
and takes its group's smallest id (null if there is none); of equal ids in a group the id is the same;
a very long text is hashed whole in one task, in about 40 times its size; repeated rows come back as often as they came; an empty
table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import offsets, partitions_for, slices, utf8, with_fields, written

SEED = 42
N_PIVOTS = 24
MAX_GROUP = 4096
LAST_LEVEL = 5


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    n = max(1, len(words) - k + 1) if words else 0
    joined = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64, n) if n else np.zeros(0, np.uint64)


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per run of ``counts[i]`` hashes: the bits set in over half of them (an empty run: zero)."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if full.size:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, offsets(counts[full])[:-1], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and ``fp``, the 64 bits as a signed long."""
    def sign(batches):
        for piece in slices(batches, "body", 2 << 20):
            parts = [shingle_hashes(b.lower().split(), shingle) if b else np.zeros(0, np.uint64)
                     for b in piece.column(1).to_pylist()]
            fp = majority_bits(np.concatenate(parts), np.array([len(p) for p in parts]))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    return utf8(docs, id_col, text).mapInArrow(sign, with_fields(docs, id_col, "fp bigint"))


def refine_masks(mask: int, parts: int) -> list[int]:
    """The masks that add to ``mask`` one of ``parts`` parts of the bits outside it."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in rest[i * len(rest) // parts:(i + 1) * len(rest) // parts]) for i in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots() -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random bit patterns."""
    return np.array([xxhash.xxh64_intdigest(b"pivot%d" % i, SEED) for i in range(N_PIVOTS)], np.uint64)


def group_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links inside groups of equal ``key``: pairs (member, root) that keep every link's connectivity."""
    table = np.bitwise_count(fp[:, None] ^ pivots()[None]).astype(np.int8)
    order = np.lexsort((table[:, 0], key))
    key, fp, table = key[order], fp[order], table[order]
    root = np.arange(len(fp))
    at, step = np.arange(len(fp)), 1
    while True:
        at = at[at + step < len(fp)]
        at = at[(key[at] == key[at + step]) & (table[at + step, 0] - table[at, 0] <= max_bits)]
        if not at.size:
            break
        pair = at[np.abs(table[at] - table[at + step]).max(axis=1) <= max_bits]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= max_bits]
        while pair.size:
            a, b = root[pair], root[pair + step]
            pair, a, b = pair[a != b], a[a != b], b[a != b]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        step += 1
    tied = np.flatnonzero(root != np.arange(len(fp)))
    return fp[tied], fp[root[tied]]


def near_links(values: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``values.fp`` with the components of "within max_bits"."""
    spark, parts = values.sparkSession, max_bits + 1
    level, links = 2, None
    masks = [m for part in refine_masks(0, parts) for m in refine_masks(part, parts)]
    groups = values.select("fp", F.explode(F.array(*map(F.lit, map(_signed, masks)))).alias("mask"))
    while True:
        groups = written(groups.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-groups")
        sizes = groups.groupBy("mask", "key").count().where("count > 1")
        heavy = sizes.where(F.col("count") > MAX_GROUP) if level < LAST_LEVEL else sizes.where("false")
        heavy = written(heavy.select("mask", "key"), "simhash-heavy")
        light = sizes.where(F.col("count") <= MAX_GROUP) if level < LAST_LEVEL else sizes
        members = groups.join(light.select("mask", "key"), ["mask", "key"], "left_semi")

        def compare(batches):
            rest = None
            for batch in batches:
                key = np.stack([batch.column(i).to_numpy() for i in range(3)])
                key = key if rest is None else np.concatenate([rest, key], axis=1)
                new = np.flatnonzero((key[:2, 1:] != key[:2, :-1]).any(axis=0)) + 1
                cut = new[-1] if new.size else 0
                rest, done = key[:, cut:], key[:, :cut]
                yield from emit(done)
            if rest is not None:
                yield from emit(rest)

        def emit(key):
            if key.shape[1] > 1:
                group = np.cumsum(np.r_[True, (key[:2, 1:] != key[:2, :-1]).any(axis=0)])
                a, b = group_links(group, np.ascontiguousarray(key[2]).view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        found = (members.select("mask", "key", "fp").repartition(partitions_for(spark), "mask", "key")
                 .sortWithinPartitions("mask", "key").mapInArrow(compare, "a bigint, b bigint"))
        links = found if links is None else links.unionByName(found)
        if not heavy.take(1):
            return links.distinct()
        masks = {m: refine_masks(m, parts) for m in masks}
        finer = F.create_map(*(x for m, subs in masks.items()
                               for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(s)) for s in subs)))))
        groups = groups.join(heavy, ["mask", "key"], "left_semi").select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
        masks = [s for subs in masks.values() for s in subs]
        level += 1


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``links`` (a, b)."""
    edges = written(links.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "cc")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        for star in ("large", "small"):
            both = edges.select("a", "b")
            if star == "large":
                both = both.unionByName(edges.selectExpr("b as a", "a as b"))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            least = least.select(F.col("a").alias("u"), "m")
            joined = both.join(least, F.col("a") == F.col("u"))
            if star == "large":  # neighbours above u go to the least node around u
                edges = joined.where("b > a").selectExpr("b as a", "m as b")
            else:                # u and its lower neighbours go to the least of them
                edges = joined.selectExpr("b as a", "m as b").unionByName(least.selectExpr("u as a", "m as b"))
            edges = written(edges.where("a <> b").distinct(), "cc")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: the id, ``fp`` (signed long) and ``component_id``, the least id linked to it."""
    signed = written(fingerprints(docs, shingle, id_col, text), "simhash")
    values = signed.groupBy("fp").agg(F.min(id_col).alias("least"))
    values = written(values, "simhash-values")
    nodes = components(near_links(values.select("fp"), max_bits))
    rooted = values.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    owner = written(rooted.join(least, "root").select("fp", "component_id"), "simhash-owner")
    return signed.join(owner, "fp").select(id_col, "fp", "component_id")
