import re

import duckdb

from vistasieve.llm import sentence_spans as ss
from vistasieve.llm.queries import SENTENCE_SPAN


def split(text):
    return [m.group(0) for m in re.finditer(ss.SENTENCE.replace(r"\z", r"\Z"), text)] if text else []


def brute(documents, span):
    seen, out = set(), {}
    for doc, text in sorted(documents, key=lambda x: x[0]):
        parts = split(text)
        keys = [p.strip(ss.BLANKS) for p in parts]
        gone = set()
        for i in range(len(keys)):
            for k in range(1, min(span, len(keys) - i) + 1):
                run = tuple(keys[i:i + k])
                if k == min(span, len(keys)) or sum(len(s.encode().split()) for s in run) >= ss.WORDS:
                    if run in seen:
                        gone.update(range(i, i + k))
                    seen.add(run)
        out[doc] = (text if not gone else "".join(p for i, p in enumerate(parts) if i not in gone), len(parts), len(gone))
    return out


def test_matches_brute_force(spark, documents, docs_df):
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in ss.dedup_sentences(docs_df, 3, counts=True).collect()}
    want = brute(documents, 3)
    assert got == want
    assert sum(n > 0 for _, _, n in want.values()) > 5
    kept = ss.dedup_sentences(docs_df, 3)
    assert kept.columns == docs_df.columns and kept.dtypes == docs_df.dtypes
    assert ss.dedup_sentences(docs_df.limit(0), 3).collect() == []


def test_long_passage_of_one_sentence(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"Here it starts. {passage}. End of one."), (2, f"Other words. {passage}.\nAnother end."), (3, "w1 w2 w3. Short.")]
    got = ss.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "Other words. Another end.", 3: rows[2][1]}


def test_passage_glued_into_foreign_sentences(spark):
    """Its first and last sentence belong to the neighbours; two short whole ones, or one, are left of 53 words."""
    words = [f"w{i}" for i in range(53)]
    two = [" ".join(words[a:b]) + "." for a, b in ((0, 20), (20, 31), (31, 42), (42, 53))]
    one = [" ".join(words[a:b][::-1]) + "." for a, b in ((0, 20), (20, 33), (33, 53))]
    rows = [(1, " ".join(two)), (2, " ".join(one)), (3, f"Left {' '.join(two)[:-1]} right."), (4, f"Left {' '.join(one)[:-1]} right.")]
    got = ss.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string"), SENTENCE_SPAN).collect()
    assert {r.doc_id: r.text for r in got} == {
        1: rows[0][1], 2: rows[1][1], 3: f"Left {two[0]} {two[3][:-1]} right.", 4: f"Left {one[0]} {one[2][:-1]} right."}


def test_sentences_concatenate(documents):
    assert all("".join(split(t)) == t for _, t in documents if t and t.strip(ss.BLANKS))


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "A a. B b. C c."), (1, "A a. B b. C c."), (None, "A a. B b. C c. D d."), (2, None)]
    got = ss.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == [
        ("1", ""), ("1", ""), ("2", "None"), ("None", "A a. B b. C c. D d.")]


def test_oracle_agrees_with_brute_force(documents):
    import hashlib

    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(documents, columns=["doc_id", "text"]))
    got = {r[0]: r[1:] for r in con.execute(ss.oracle(3)).fetchall()}
    assert got == {d: (n, k, None if t is None else hashlib.sha256(t.encode()).hexdigest())
                   for d, (t, n, k) in brute(documents, 3).items()}
