import numpy as np
import xxhash

from vistasieve.llm import simhash_pivot as sp


def brute_fp(text):
    words = text.encode().lower().split() if text else []
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, max_bits):
    least = list(range(len(fps)))
    ids = np.array(fps, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(ids ^ f) <= max_bits) for f in ids]
    while True:
        new = [min(least[j] for j in near[i]) for i in range(len(fps))]
        if new == least:
            return least
        least = new


def test_documents_match_brute_force(spark, documents, docs_df):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in sp.near_duplicates(docs_df).collect()}
    fps = [brute_fp(t) for _, t in documents]
    least = brute_components(fps, 2)
    order = sorted(range(len(documents)), key=lambda i: documents[i][0])
    assert order == list(range(len(documents)))
    assert got == {d: (fps[i], documents[least[i]][0]) for i, (d, _) in enumerate(documents)}
    assert sp.near_duplicates(docs_df.limit(0)).collect() == []


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "q")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in sp.near_duplicates(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]


def test_dense_groups_are_split(spark, monkeypatch):
    """Chains and balls of values around few centres, with groups far above the split size."""
    monkeypatch.setattr(sp, "MAX_GROUP", 8)
    rng = np.random.default_rng(5)
    fps = []
    for centre in rng.integers(0, 2**63, 4).tolist():
        for _ in range(80):
            fps.append(centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))))
            centre ^= (1 << int(rng.integers(0, 64))) if rng.random() < 0.3 else 0
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    nodes = sp.components(sp.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2)).collect()
    root = {f: f for f in signed} | {r.node: r.root for r in nodes}
    least = brute_components(fps, 2)
    groups = {}
    for f, l in zip(signed, least):
        groups.setdefault(l, set()).add(root[f])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups) > 3
