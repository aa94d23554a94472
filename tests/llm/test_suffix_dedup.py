import random

import numpy as np
import pytest

from vistasieve.llm import exchange
from vistasieve.llm import suffix_dedup as sd


def brute(documents, length=50):
    least = {}
    bodies = [(sd.NO_ID if d is None else d, d, (t or "").encode()) for d, t in documents]
    for k, _, b in bodies:
        for i in range(len(b) - length + 1):
            least[b[i:i + length]] = min(k, least.get(b[i:i + length], k))
    out = []
    for k, d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < k:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.remove_repeats(df).collect()), key=str)


def test_documents_match_brute_force(documents, docs_df):
    want = brute(documents)
    assert got(docs_df) == want
    assert sum(w[2] > 0 for w in want) > 5


@pytest.mark.parametrize("block,segment", [(700, 1 << 20), (5000, 400)])
def test_small_blocks_and_segments(spark, monkeypatch, block, segment):
    """Periodic texts, passages at all offsets, copies, near copies; many blocks, shards and segments."""
    monkeypatch.setattr(sd, "SEGMENT", segment)
    monkeypatch.setattr(exchange, "SHARD_BYTES", 3000)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", block)
    rng = random.Random(4)
    text = lambda n, a="abcdefgh ": "".join(rng.choice(a) for _ in range(n))
    passage = text(130)
    docs = [(i, text(rng.randint(0, 200)) + passage[rng.randint(0, 60):rng.randint(70, 130)] + text(rng.randint(0, 90)))
            for i in range(60)]
    docs += [(i, docs[i % 7][1][:rng.randint(30, 200)] + "é") for i in range(60, 90)]
    docs += [(i, "ab" * rng.randint(20, 60)) for i in range(90, 96)] + [(i, "a" * (40 + i % 17)) for i in range(96, 110)]
    docs += [(None, docs[3][1]), (None, docs[3][1]), (4, docs[4][1]), (200, text(900, "ab")), (201, text(2000, "ab")), (202, None)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert got(df) == brute(docs)
    assert got(df.limit(0)) == []


def test_bucket_pointers_sort_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 900).astype(np.uint8)
    text[300:500] = text[:200]
    bucket, raw = sd.bucket_pointers(text, 50), text.tobytes()
    full = [raw[i:i + 50] for i in range(len(raw))]
    order = np.argsort(bucket, kind="stable")
    whole = [i for i in order.tolist() if len(full[i]) == 50]
    assert [full[i] for i in whole] == sorted(full[i] for i in whole)
    assert all((bucket[i] == bucket[j]) == (full[i] == full[j]) for i in range(0, 850, 7) for j in range(0, 850, 5))
