"""Near-duplicate search and first-kept-wins removal.

Pairs within Hamming distance t are found with a block equi-join: the 64 bits
are cut into m blocks; two hashes within t differ in at most t blocks, so they
agree on at least m - t of them (pigeonhole). Each hash is keyed once per
combination of m - t blocks; a candidate pair is emitted only for the first
combination (in block order) it agrees on, so no pair is produced twice and no
``distinct`` shuffle is needed. m = t + 1 keys on single blocks; a larger m
lengthens the keys (fewer chance candidates per key at very large hash counts)
at the cost of more key copies per hash.

First-kept-wins is not connected components: an item is a duplicate only if an
earlier *kept* item is within t. But no decision reaches beyond a component of
near items, so components come first, from star-shaped links that tasks find
inside key groups, and each is swept in order by one task (see
``dedup_first_kept``). Only a component above ``MAX_COMPONENT`` hashes is solved as
a fixpoint over key groups. Pairs never leave a task. Equal hashes are
collapsed first, so a hot hash (blank frames) is one node.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistasieve.operators.components import connected
from vistasieve.operators.rank import materialize, spread

_MASK64 = (1 << 64) - 1


def _signed(v: int) -> int:
    v &= _MASK64
    return v - (1 << 64) if v >= (1 << 63) else v


def _block_masks(m: int) -> list[int]:
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(m)]


def choose_blocks(n: int, t: int, max_extra: int = 10) -> int:
    """Number of blocks m for ``n`` distinct hashes: minimise key copies plus chance candidates.

    Copies per hash are C(m, m - t); a key covers about 64 (m - t) / m bits, so
    unrelated hashes share a key with probability 2^-bits. Expected work is
    C(m, m-t) * (n + n^2 / 2^(bits + 1)); m = t + 1 for small n, longer keys as
    n grows (for t = 5: m = 6 up to about 10^4 hashes, 7 near 10^6, 9 near 10^8).
    """
    best, best_cost = t + 1, None
    for m in range(t + 1, t + 1 + max_extra):
        copies = comb(m, m - t)
        bits = 64 * (m - t) / m
        cost = copies * (n + n * n / 2 ** (bits + 1))
        if best_cost is None or cost < best_cost:
            best, best_cost = m, cost
    return best


def hash64(hi: F.Column, lo: F.Column) -> F.Column:
    """One signed 64-bit value from two 32-bit halves (kept as BIGINT for SQL parity)."""
    return F.shiftleft(hi, 32).bitwiseOR(lo.bitwiseAND(F.lit(0xFFFFFFFF)))


def _keyed(df: DataFrame, t: int, m: int) -> tuple[DataFrame, list[int]]:
    blocks = _block_masks(m)
    k = m - t
    combos = []
    for combo in combinations(range(m), k):
        bits = 0
        cmask = 0
        for b in combo:
            bits |= blocks[b]
            cmask |= 1 << b
        combos.append(F.struct(F.lit(cmask).alias("cmask"), F.lit(_signed(bits)).cast("long").alias("bits")))
    exploded = df.select("*", F.explode(F.array(*combos)).alias("_c"))
    keyed = exploded.select(
        *df.columns, F.col("_c.cmask").alias("cmask"), F.col("h64").bitwiseAND(F.col("_c.bits")).alias("bkey")
    )
    return keyed, blocks


def _canonical_mask(xor: F.Column, blocks: list[int], k: int) -> F.Column:
    """Mask of the first ``k`` blocks (in order) on which the pair agrees."""
    agree = [(xor.bitwiseAND(F.lit(_signed(b)).cast("long")) == 0).cast("int") for b in blocks]
    total = F.lit(0)
    before = F.lit(0)
    for i, a in enumerate(agree):
        total = total + F.when((a == 1) & (before < k), F.lit(1 << i)).otherwise(F.lit(0))
        before = before + a
    return total


def collapse_equal(hashes: DataFrame, key: str = "image_id", order: str = "ord") -> DataFrame:
    """One row per distinct hash: ``h64, id`` (earliest item), ``ord``, ``n`` (items sharing it).

    A hash aggregate with map-side partial results, so a hash carried by a
    third of all items (blank frames) is reduced on every task first.
    """
    base = hashes.where(F.col("hash_hi").isNotNull() & F.col("hash_lo").isNotNull()).select(
        F.col(key).alias("id"), F.col(order).alias("ord"), hash64(F.col("hash_hi"), F.col("hash_lo")).alias("h64")
    )
    return base.groupBy("h64").agg(F.min(F.struct("ord", "id")).alias("_r"), F.count(F.lit(1)).alias("n")).select(
        "h64", F.col("_r.id").alias("id"), F.col("_r.ord").alias("ord"), "n"
    )


def near_pairs(reps: DataFrame, t: int, num_blocks: int | None = None) -> DataFrame:
    """Pairs of distinct hashes (``reps``: h64, id, ord, ...) within ``t``, earlier first; tasks follow the number of keys."""
    n = reps.count()
    m = num_blocks or choose_blocks(n, t)
    if m <= t:
        raise ValueError("num_blocks must exceed the distance threshold")
    keyed, blocks = _keyed(reps, t, m)
    a = keyed.select(*[F.col(c).alias(f"a_{c}") for c in keyed.columns])
    b = keyed.select(*[F.col(c).alias(f"b_{c}") for c in keyed.columns])
    copies = n * comb(m, m - t)
    a, b = spread(a, copies, "a_cmask", "a_bkey"), spread(b, copies, "b_cmask", "b_bkey")
    j = a.join(b, (F.col("a_cmask") == F.col("b_cmask")) & (F.col("a_bkey") == F.col("b_bkey")) & (F.col("a_ord") < F.col("b_ord")))
    xor = F.col("a_h64").bitwiseXOR(F.col("b_h64"))
    dist = F.bit_count(xor)
    j = j.where(dist <= t).where(_canonical_mask(xor, blocks, m - t) == F.col("a_cmask"))
    extra = [c for c in reps.columns if c not in ("h64", "id", "ord")]
    return j.select(
        F.col("a_id"), F.col("b_id"), "a_ord", "b_ord", dist.cast("int").alias("distance"),
        *[F.col(f"a_{c}") for c in extra], *[F.col(f"b_{c}") for c in extra],
    )


def hamming_pairs(
    hashes: DataFrame, t: int, key: str = "image_id", order: str = "ord", num_blocks: int | None = None
) -> DataFrame:
    """Pairs of distinct hash values within Hamming distance ``t``.

    Equal hashes are collapsed first, so a group of identical hashes never
    expands into all its pairs: each side is its earliest item (``a_id``,
    ``b_id``, with ``a`` earlier) plus ``a_n``/``b_n``, the number of items
    sharing that hash. Null hashes never pair. ``num_blocks`` defaults to
    ``choose_blocks`` of the distinct-hash count (one count job).
    """
    # written once: the block count and the self-join both read it
    return near_pairs(materialize(collapse_equal(hashes, key, order), "hash-reps"), t, num_blocks)


# Key groups with more members are split by further blocks of bits, at most SPLITS times.
MAX_GROUP = 4096
SPLITS = 4
# Hashes of a component that one task sweeps (about 150 bytes each).
MAX_COMPONENT = 1 << 20
SWEEP_TOGETHER = 4096  # larger components are swept one by one


def _key_groups(reps: DataFrame, t: int, m: int) -> DataFrame:
    """``id, ord, h64, bits, bkey``: every hash under the bits of each block combination, groups of two or more only.

    A group above MAX_GROUP is dealt anew: its members agree on ``bits``; cut the other bits into ``t + 1`` parts, and
    two hashes within ``t`` agree on one of them. So no near pair loses its common group, and unrelated hashes that
    share one block of bits part.
    """
    blocks = _block_masks(m)
    masks = sorted({_signed(sum(combo)) for combo in combinations(blocks, m - t)})
    keyed = reps.select("id", "ord", "h64", F.explode(F.array(*map(F.lit, masks))).alias("bits"))
    done = []
    if reps.count() <= MAX_GROUP:  # no group can be too large
        return materialize(keyed.withColumn("bkey", F.col("h64").bitwiseAND(F.col("bits"))), "dedup-keyed")
    for level in range(SPLITS + 1):
        keyed = materialize(keyed.withColumn("bkey", F.col("h64").bitwiseAND(F.col("bits"))), "dedup-keyed")
        sizes = materialize(keyed.groupBy("bits", "bkey").agg(F.count(F.lit(1)).alias("_g")).where("_g > 1"), "dedup-sizes")
        last = level == SPLITS
        light = sizes if last else sizes.where(F.col("_g") <= MAX_GROUP)
        done.append(keyed.join(light, ["bits", "bkey"], "left_semi"))
        heavy = sizes.where(F.col("_g") > MAX_GROUP)
        if last or heavy.isEmpty():
            break
        finer = {}
        for x in {r[0] for r in heavy.select("bits").distinct().collect()}:  # at most one for each mask
            rest = [b for b in range(64) if not x >> b & 1]
            cuts = [rest[i * len(rest) // (t + 1):(i + 1) * len(rest) // (t + 1)] for i in range(t + 1)]
            finer[x] = [_signed((x & _MASK64) | sum(1 << b for b in c)) for c in cuts]
        table = F.create_map(*(y for x, subs in finer.items() for y in (F.lit(x), F.array(*map(F.lit, subs)))))
        keyed = keyed.join(heavy, ["bits", "bkey"], "left_semi").select(
            "id", "ord", "h64", F.explode(table[F.col("bits")]).alias("bits"))
    return reduce(DataFrame.unionByName, done).select("id", "ord", "h64", "bits", "bkey")


def _in_groups(groups: DataFrame, work: Callable, shape: T.StructType | str, keys: tuple[str, ...] = ("bits", "bkey")) -> DataFrame:
    """``work(rows, group numbers)`` on whole groups of equal ``keys`` (longs), members by ``ord``, many groups at a time."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        waiting, last = [], None  # rows of the group that may go on in the next batch
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in keys]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            cuts = [*([0] if last is not None and last != tuple(c[0] for c in columns) else []), *new[-1:].tolist()]
            if cuts:  # up to there, whole groups
                done = pa.Table.from_batches([*waiting, batch.slice(0, cuts[-1])])
                waiting = []
                if done.num_rows:
                    columns = [done.column(c).to_numpy() for c in keys]
                    change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
                    yield from work(done, np.cumsum(np.r_[0, change]))
            waiting.append(batch.slice(cuts[-1] if cuts else 0))
            last = tuple(batch.column(c)[-1].as_py() for c in keys)
        if waiting:
            done = pa.Table.from_batches(waiting)
            yield from work(done, np.zeros(done.num_rows, np.int64))

    return groups.repartition(n, *keys).sortWithinPartitions(*keys, "ord").mapInArrow(run, shape)


def _near(h: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    return np.bitwise_count(h[a] ^ h[b]) <= t


def _stars(group: np.ndarray, h: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first of its star) that connect what is within ``t`` inside each group, fewer than its members.

    A reached member draws in all that are near it and not yet reached; if none is left to do so, the next star begins.
    """
    star = np.full(len(h), -1)
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if hi - lo == 2:
            if int(h[lo] ^ h[lo + 1]).bit_count() <= t:
                star[lo + 1] = lo
        elif hi - lo > 2:
            open_ = np.arange(lo + 1, hi)
            queue, first = [lo], lo
            while open_.size:
                if not queue:
                    first = int(open_[0])
                    queue, open_ = [first], open_[1:]
                near = np.bitwise_count(h[open_] ^ h[queue.pop()]) <= t
                if near.any():
                    star[open_[near]] = first
                    queue += open_[near].tolist()
                    open_ = open_[~near]
    at = np.flatnonzero(star >= 0)
    return at, star[at]


def _sweep(group: np.ndarray, h: np.ndarray, t: int) -> np.ndarray:
    """For each member (in order inside its group) the first kept member before it within ``t``, or -1 if it is kept.

    Every group keeps its first open member and drops what is near it, all groups at a time. Larger groups are swept one
    by one, with the kept members under the ``t + 1`` blocks of their bits: one within ``t`` agrees on a block.
    """
    of, size = np.full(len(h), -1), np.bincount(group) if len(group) else np.zeros(0, np.int64)
    open_ = np.flatnonzero(size[group] <= SWEEP_TOGETHER)
    while open_.size:
        first = np.r_[True, group[open_][1:] != group[open_][:-1]]
        keeper = open_[first][np.cumsum(first) - 1]
        near = _near(h, open_, keeper, t)
        of[open_[near & ~first]] = keeper[near & ~first]
        open_ = open_[~near]
    for g in np.flatnonzero(size > SWEEP_TOGETHER):
        members = np.flatnonzero(group == g)
        kept: list[dict[int, list[int]]] = [{} for _ in range(t + 1)]
        masks, values = _block_masks(t + 1), h[members].tolist()
        for i, v in zip(members.tolist(), values):
            lists = [k.get(v & m) for k, m in zip(kept, masks)]
            best = min((next((j for j, w in x if (v ^ w).bit_count() <= t), i) for x in lists if x), default=i)
            if best < i:
                of[i] = best
            else:
                for k, m in zip(kept, masks):
                    k.setdefault(v & m, []).append((i, v))
    return of


def _behind_earlier(group: np.ndarray, h: np.ndarray, t: int) -> np.ndarray:
    """Members with an earlier member of their group within ``t``, looking back one place at a time."""
    hit, at, step = np.zeros(len(h), bool), np.arange(len(h)), 1
    while True:
        at = at[at >= step]
        at = at[group[at - step] == group[at]]
        if not at.size:
            return hit
        near = _near(h, at, at - step, t)
        hit[at[near]] = True
        at, step = at[~near], step + 1


def _first_kept(group: np.ndarray, h: np.ndarray, kept: np.ndarray, t: int) -> np.ndarray:
    """For each member not kept, the earliest kept member of its group before it within ``t``, or -1."""
    found, places = np.full(len(h), -1), np.flatnonzero(kept)
    at = np.flatnonzero(~kept)
    nxt = np.searchsorted(places, np.searchsorted(group, group[at]))
    while at.size and places.size:
        ok = nxt < len(places)
        at, nxt = at[ok], nxt[ok]
        ok = places[nxt] < at
        at, nxt = at[ok], nxt[ok]
        near = _near(h, at, places[nxt], t)
        found[at[near]] = places[nxt[near]]
        at, nxt = at[~near], nxt[~near] + 1
    return found


def _in_rounds(groups: DataFrame, t: int) -> DataFrame:
    """``id`` and ``dup_of`` of the duplicates among hashes given in their key groups, for components that no task holds.

    Per round, an open item with no earlier open item truly within ``t`` in any of its groups is kept: no earlier kept
    item is within ``t`` either, or it would be decided. Open items behind a newly kept one within ``t`` become duplicates,
    and the groups of what is still open are written for the next round. ``dup_of`` is the earliest kept item over all
    groups of a duplicate.
    """
    one_id = T.StructType([groups.schema["id"]])

    def ids(rows, where):
        return pa.table({"id": rows.column("id").take(pa.array(np.flatnonzero(where)))}).to_batches()

    def behind_open(rows, group):
        yield from ids(rows, _behind_earlier(group, rows.column("h64").to_numpy().view(np.uint64), t))

    def behind_kept(rows, group):
        kept = rows.column("kept").to_numpy()
        yield from ids(rows, _first_kept(group, rows.column("h64").to_numpy().view(np.uint64), kept, t) >= 0)

    def original(rows, group):
        kept = rows.column("kept").to_numpy()
        first = _first_kept(group, rows.column("h64").to_numpy().view(np.uint64), kept, t)
        dup = pa.array(np.flatnonzero(first >= 0))
        src = pa.array(first[first >= 0])
        yield from pa.table({"id": rows.column("id").take(dup), "a_ord": rows.column("ord").take(src),
                             "a_id": rows.column("id").take(src)}).to_batches()

    def flagged(rows, kept):
        return rows.join(kept.select("id", F.lit(True).alias("_k")), "id", "left").withColumn(
            "kept", F.coalesce("_k", F.lit(False))).drop("_k")

    whole, all_kept = groups, []
    open_ids = materialize(groups.select("id").distinct(), "dedup-open")
    while not open_ids.isEmpty():
        blocked = _in_groups(groups, behind_open, one_id).distinct()
        kept = materialize(open_ids.join(blocked, "id", "left_anti"), "dedup-kept")
        all_kept.append(kept)
        dup = _in_groups(flagged(groups, kept), behind_kept, one_id)
        open_ids = materialize(open_ids.join(kept.unionByName(dup.distinct()), "id", "left_anti"), "dedup-open")
        groups = materialize(groups.join(open_ids, "id", "left_semi"), "dedup-groups")
    shape = T.StructType([whole.schema["id"], T.StructField("a_ord", whole.schema["ord"].dataType),
                          T.StructField("a_id", whole.schema["id"].dataType)])
    found = _in_groups(flagged(whole, reduce(DataFrame.unionByName, all_kept)), original, shape)
    return found.groupBy("id").agg(F.min(F.struct("a_ord", "a_id")).alias("_o")).select("id", F.col("_o.a_id").alias("dup_of"))


def dedup_first_kept(
    hashes: DataFrame,
    t: int,
    key: str = "image_id",
    order: str = "ord",
    enabled: bool = True,
    num_blocks: int | None = None,
) -> DataFrame:
    """``key, is_dup, duplicate_of`` in the first-kept-wins semantics.

    Unreadable items (null hash) are kept. ``duplicate_of`` is the earliest
    kept item within ``t``.

    Plan (exact; no pair of items ever leaves a task):
    1. equal hashes collapse to their earliest item;
    2. each distinct hash joins one group per block combination, written once; large groups are split by further bits;
    3. tasks link what is truly within ``t`` inside a group, as stars, and the links give components;
    4. each component is swept in order by one task: the first open hash is kept, what is near it goes. The number of
       jobs does not follow chains of near items;
    5. components above ``MAX_COMPONENT`` hashes are solved in rounds over their key groups instead (``_in_rounds``).
    """
    items = hashes.select(
        F.col(key).alias("id"), F.col(order).alias("ord"),
        F.when(F.col("hash_hi").isNotNull() & F.col("hash_lo").isNotNull(), hash64(F.col("hash_hi"), F.col("hash_lo"))).alias("h64"),
    )
    id_type = hashes.schema[key].dataType
    if not enabled:
        return items.select(F.col("id").alias(key), F.lit(False).alias("is_dup"), F.lit(None).cast(id_type).alias("duplicate_of"))

    reps = materialize(collapse_equal(hashes, key, order).select("h64", "id", "ord"), "dedup-reps")
    m = num_blocks or choose_blocks(reps.count(), t)
    if m <= t:
        raise ValueError("num_blocks must exceed the distance threshold")
    groups = _key_groups(reps, t, m)

    def link(rows, group):
        h = rows.column("h64").to_numpy()
        a, b = _stars(group, h.view(np.uint64), t)
        yield pa.RecordBatch.from_arrays([pa.array(h[a]), pa.array(h[b])], names=["a", "b"])

    nodes = connected(_in_groups(groups, link, "a bigint, b bigint"))
    members = reps.join(nodes, F.col("h64") == F.col("node")).select("root", "ord", "id", "h64")
    sizes = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("_n"))
    huge = materialize(sizes.where(F.col("_n") > MAX_COMPONENT).select("root"), "dedup-huge")
    some_huge = not huge.isEmpty()
    shape = T.StructType([reps.schema["id"], T.StructField("dup_of", reps.schema["id"].dataType)])

    def sweep(rows, group):
        of = _sweep(group, rows.column("h64").to_numpy().view(np.uint64), t)
        dup, ids = np.flatnonzero(of >= 0), rows.column("id")
        yield from pa.table({"id": ids.take(pa.array(dup)), "dup_of": ids.take(pa.array(of[dup]))}).to_batches()

    orig = _in_groups(members.join(huge, "root", "left_anti") if some_huge else members, sweep, shape, ("root",))
    if some_huge:
        inside = members.join(huge, "root", "left_semi").select("h64")
        orig = orig.unionByName(_in_rounds(materialize(groups.join(inside, "h64", "left_semi"), "dedup-groups"), t))
    rep_out = materialize(reps.join(orig, "id", "left").select("h64", F.col("id").alias("rep_id"), "dup_of"), "dedup-result")

    # later items with a representative's hash follow the representative; both sides are shuffled on the hash for
    # this join alone, so adaptive execution splits a hash that many items carry
    hashed = items.where(F.col("h64").isNotNull()).join(rep_out, "h64")
    is_rep = F.col("id") == F.col("rep_id")
    members = hashed.select(
        "id", (~is_rep | F.col("dup_of").isNotNull()).alias("is_dup"),
        F.coalesce("dup_of", F.when(~is_rep, F.col("rep_id"))).alias("duplicate_of"))
    unhashed = items.where(F.col("h64").isNull()).select(
        "id", F.lit(False).alias("is_dup"), F.lit(None).cast(id_type).alias("duplicate_of"))
    return members.unionByName(unhashed).select(F.col("id").alias(key), "is_dup", "duplicate_of")


def dedup_summary(result: DataFrame) -> DataFrame:
    """Kept / duplicate counts."""
    return result.agg(
        F.count_if(~F.col("is_dup")).alias("kept"),
        F.count_if(F.col("is_dup")).alias("duplicates"),
    )
