import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vistasieve.llm import periodic_runs as pr
from vistasieve.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute(words, least=24):
    """(start, length, period) of all runs, by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def matches(texts, least=24):
    many, start, length, period, count, left = pr.runs_of_texts([" ".join(t).encode() for t in texts], least)
    at = np.r_[0, np.cumsum(many)]
    for i, words in enumerate(texts):
        got = list(zip(*(x[at[i]:at[i + 1]].tolist() for x in (start, length, period))))
        want = brute(words, least)
        assert got == want and count[i] == len(words) and left[i].decode() == collapsed(words, want)
    return int(many.sum())


def planted(r):
    n, k = r.randint(0, 260), r.choice([1, 2, 3, 50])
    words = [str(r.randrange(k)) for _ in range(n)]
    for _ in range(r.randint(0, 4) if n else 0):
        a = r.randrange(n)
        p, size = r.randint(1, max(1, (n - a) // 3)), r.randint(0, n - a)
        if r.random() < 0.4:  # a period that holds a small period itself
            inner = r.randint(1, 4)
            for i in range(a, min(n, a + p)):
                words[i] = words[a + (i - a) % inner] if r.random() < 0.97 else "z"
        for i in range(a, a + size):
            words[i] = words[a + (i - a) % p]
    return words


def test_planted_runs_at_all_scales():
    found = sum(matches([planted(random.Random(100 * s + i)) for i in range(20)]) for s in range(25))
    assert found > 200


def test_every_period_at_its_shortest_length():
    r = random.Random(3)
    for q in range(1, 90):
        base = [str(r.randrange(10**6)) for _ in range(q)]
        least = max(24, 3 * q)
        texts = [["x"] * k + [base[i % q] for i in range(size)] + ["y"] for k in (0, 3) for size in (least - 1, least, least + 1)]
        assert matches(texts) >= 4
        # the period is one small period and a single other word
        texts = [[("a" if i % q else "b") for i in range(size)] for size in (least - 1, least, 3 * least)]
        matches(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.integers(3, 24))
def test_small_alphabets(texts, least):
    matches([[str(w) for w in t] for t in texts], least)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    words = [w.decode() for w in words]
    runs = brute(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    rows += [(1000 + i, " \n".join(planted(r))) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "a"), (2004, "a " * 100), (2005, "a " * 100), (2006, "ü ü " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(x) for x in op12_periodic_runs(spark, str(tmp_path)).collect()}
    want = {expected(*x) for x in rows}
    assert got == want and sum(1 for x in want if x[1]) > 30


def test_odd_rows(spark, docs_df, documents):
    rows = pr.periodic_runs(docs_df).collect()
    assert len(rows) == len(documents)
    texts = dict(documents)
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        assert r.n_words == len(words)
        if not r.runs:
            assert r.collapsed == b" ".join(words).decode()
    df = spark.createDataFrame([(None, "a " * 30), (None, "a " * 30), (1, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(df).collect())
    assert got == [(False, [], ""), (True, [(0, 30, 1)], "a"), (True, [(0, 30, 1)], "a")]
    assert pr.periodic_runs(docs_df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [2_000_000])
def test_a_long_text(n):
    """A text of 13 MB: a period of a third of it, and words without repeats."""
    r = np.random.default_rng(1)
    base = [b"%x" % x for x in r.integers(0, 2**60, n // 3)]
    many, start, length, period, count, left = pr.runs_of_texts([b" ".join(base * 3), b" ".join(base)])
    assert (many.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([1, 0], [0], [3 * len(base)], [len(base)])
    assert left[0] == left[1] == b" ".join(base)
