"""Property-based checks of the two ordered algorithms against their plain statements."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_dedup import SCHEMA as HSCHEMA
from test_dedup import seq_first_kept
from test_selection import SCHEMA, greedy

from vistasieve.operators import dedup, quota

CLASSES = ["a", "b", "c", "d"]

rows_st = st.lists(
    st.tuples(st.booleans(), st.lists(st.sampled_from(CLASSES), max_size=3, unique=True)),
    min_size=0, max_size=40,
)
targets_st = st.dictionaries(st.sampled_from(CLASSES), st.integers(0, 6), min_size=1)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, targets=targets_st, cap=st.one_of(st.none(), st.integers(1, 40)),
       max_images=st.one_of(st.none(), st.integers(1, 12)))
def test_selection_equals_greedy(spark, rows, targets, cap, max_images):
    data = [(i + 1, "s", i + 1, valid, sorted(cls)) for i, (valid, cls) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    got = quota.select_quota(df, targets, max_images=max_images,
                             max_rows_scanned=cap)
    assert sorted(r[0] for r in got.select("image_id").collect()) == sorted(greedy(data, targets, max_images, cap))


hash_st = st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(0, 63), max_size=6)), min_size=1, max_size=25)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(spec=hash_st, t=st.integers(0, 6))
def test_dedup_equals_sequential(spark, spec, t):
    bases = [0x0123456789ABCDEF, 0x7EDCBA9876543210, 0x00FF00FF00FF00FF, 0x5555AAAA5555AAAA]
    rows = []
    for i, (b, flips) in enumerate(spec):
        h = bases[b]
        for f in flips:
            h ^= 1 << f
        rows.append((i, i, h >> 32, h & 0xFFFFFFFF))
    got = dedup.dedup_first_kept(spark.createDataFrame(rows, HSCHEMA), t)
    res = {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got.collect()}
    assert res == seq_first_kept(rows, t)
