import hashlib

import numpy as np
import pytest

from vistasieve.llm import decontam_fm
from vistasieve.llm.decontam_fm import FMIndex, Phrases, decontaminate, search_shard, verdicts, words_of
from vistasieve.llm.queries import ORACLE, op8_decontaminate
from vistasieve.plans.check import duck, rows_of


def brute(documents, items, width=13):
    return {d: v[:4] for d, v in brute_with_items(documents, items, width).items()}


def brute_with_items(documents, items, width=13):
    out = {}
    phrases = {}
    for item, text in items:
        w = words_of(text.encode() if text is not None else None)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + width]), set()).update(() if item is None else (str(item),))
    for doc, text in documents:
        w = words_of(text.encode() if text is not None else None)
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in phrases:
                    hit.update(range(i, i + size))
                    found |= phrases[tuple(w[i:i + size])]
        out[doc] = (len(w), len(hit), len(found), len(hit) > 0 and 20 * len(hit) >= len(w),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def case(documents):
    texts = [t for _, t in documents if t]
    passage = " ".join(texts[3].split()[5:40])
    items = [(1, passage), (2, texts[4]), (3, "One, two THREE"), (4, None), (5, "?!"), (None, passage.upper()), (1, texts[5])]
    docs = documents + [(200_000, "before words. " + passage + " after"), (200_001, passage * 3), (200_002, "one two three one two three")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 300])
def test_matches_brute_force(spark, case, block_bytes):
    docs, items = case
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, spans int").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = verdicts(decontaminate(df, bench, block_bytes=block_bytes)).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got} == brute(docs, items)
    assert sum(r.n_hit > 0 for r in got) > 5
    assert {r.doc_id: r.items_sha256 for r in got} == {d: v[4] for d, v in brute_with_items(docs, items).items()}


def test_empty_tables(spark, case):
    docs = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in verdicts(decontaminate(docs, none)).collect()] == [0, 0]
    assert decontaminate(docs.limit(0), none).collect() == []


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    seq = rng.integers(1, 4, 3000)
    seq[rng.integers(0, 3000, 200)] = 0
    seq[-1] = 0
    index = FMIndex(seq, 3)
    for size in (1, 2, 5, 9):
        phrases = rng.integers(1, 4, (40, size))
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            want = [i for i in range(len(seq) - size + 1) if (seq[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    df = op8_decontaminate(spark, folder)
    found = duck(folder).execute(ORACLE["op8_decontaminate"])
    want = rows_of([d[0] for d in found.description], found.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    assert any(r[want[0].index("contaminated")] for r in want[1])


def test_what_is_sent_stays_near_the_text(monkeypatch):
    import pickle

    rng = np.random.default_rng(6)
    text = " ".join("%x" % x for x in rng.integers(0, 16**5, 200_000)).encode()
    items = [(str(i), part) for i, part in enumerate(text[k:k + 600] for k in range(0, len(text), 600))]
    sent = pickle.dumps(Phrases(items, 13))
    assert len(sent) < 5 * len(text)
    monkeypatch.setattr(decontam_fm, "WINDOWS_AT_ONCE", 7)
    few = Phrases(items[:5], 13)
    counts, spans, found = search_shard([items[2][1], None, b"", b"x " + items[0][1]], few)
    assert found == [{"2"}, set(), set(), {"0"}] and spans[0] == [0, counts[0]] and spans[3] == [1, counts[3]]


def test_a_long_text():
    """20 MB in one document, with a phrase near its end, in bounded memory."""
    import tracemalloc

    phrase = b"one two three four five six seven eight nine ten eleven twelve thirteen"
    body = b"lorem ipsum dolor sit amet " * 740_000 + phrase + b" end"
    tracemalloc.start()
    counts, spans, found = search_shard([body], Phrases([("7", phrase)], 13))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts[0] == 740_000 * 5 + 14 and spans == [[3_700_000, 3_700_013]] and found == [{"7"}]
    assert peak < 12 * len(body)
