from collections import defaultdict

import corpus_pipeline as cp
import pyarrow.parquet as pq
import pytest

from vistasieve.llm import lang_cnn
from vistasieve.llm.queries import learned_language

from . import test_decontam_fm, test_sentence_spans, test_simhash_pivot
from .conftest import SF_SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def base(documents):
    rows = {r["doc_id"]: r for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    passages = [r["text"] for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    more = documents + [(300_000 + i, f"Start of it. {p}") for i, p in enumerate(passages[:3])]
    return [tuple(rows[d][c] for c in COLUMNS) if d in rows else (d, t, None, "src", len(t or "")) for d, t in more]


@pytest.fixture(scope="module")
def docs(spark, base):
    return spark.createDataFrame(base, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_each_stage_against_brute_force(spark, docs, base):
    judged = {r.doc_id: r for r in lang_cnn.predict(docs, learned_language(docs)).collect()}
    kept = [r for r in base if judged[r[0]].lang_pred != "und" and judged[r[0]].score >= cp.MIN_SCORE]
    out = cp.language_id(spark, docs, SF_SMALL)
    assert out.columns == COLUMNS and rows_of(out) == sorted(kept, key=str)
    assert len(kept) > 0.9 * len(base)

    kept.sort()
    least = test_simhash_pivot.brute_components([test_simhash_pivot.brute_fp(r[1]) for r in kept], 2)
    kept = [r for i, r in enumerate(kept) if least[i] == i]
    out = cp.near_dedup(spark, out, SF_SMALL)
    assert out.columns == COLUMNS and rows_of(out) == sorted(kept, key=str)

    cut = test_sentence_spans.brute([r[:2] for r in kept], 3)
    kept = [(r[0], cut[r[0]][0], *r[2:4], len(cut[r[0]][0])) for r in kept if cut[r[0]][0]]
    out = cp.substring_dedup(spark, out, SF_SMALL)
    assert out.columns == COLUMNS and rows_of(out) == sorted(kept, key=str)

    items = [tuple(r.values()) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    dirty = test_decontam_fm.brute([r[:2] for r in kept], items)
    assert any(x[3] for x in dirty.values())
    kept = [r for r in kept if not dirty[r[0]][3]]
    out = cp.decontaminate(spark, out, SF_SMALL)
    assert out.columns == COLUMNS and rows_of(out) == sorted(kept, key=str)

    coded = cp.encode(spark, out, SF_SMALL).collect()
    assert sorted((r.doc_id, r.decoded) for r in coded) == sorted(r[:2] for r in kept)


def test_language_stage_keeps_unsure_and_unlabelled(spark, monkeypatch):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "Some words", None, "s", 10), (2, "12 34", None, "s", 5)]
    df = spark.createDataFrame(rows, schema)
    assert rows_of(cp.language_id(spark, df, SF_SMALL)) == rows
    judged = lambda docs, model, id_col: docs.selectExpr("row", "if(row.doc_id = 1, 'en', 'und') AS lang_pred", "0.4D * (2 - row.doc_id) AS score")
    monkeypatch.setattr(cp, "learned_language", lambda docs: "model")
    monkeypatch.setattr(lang_cnn, "predict", judged)
    assert rows_of(cp.language_id(spark, df, SF_SMALL)) == rows[:1]


def test_run_applies_all_stages(spark, monkeypatch):
    def stage(name):
        return lambda s, docs, sf: docs.where(f"doc_id % {len(name)} <> 0")

    monkeypatch.setattr(cp, "STAGES", [("abc", stage("abc")), ("abcde", stage("abcde"))])
    ids = {r["doc_id"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    assert {r.doc_id for r in cp.run(spark, SF_SMALL).collect()} == {i for i in ids if i % 3 and i % 5}


def test_odd_rows(spark):
    """Null ids, repeated rows, extra columns with the stages' own names, and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, n string, body int, key int"
    text = "The cat saw the dog and ran. It was late by then. Nobody else came along."
    rows = [(None, text, "en", "s", 9, 1, "a", 2, 3), (4, text, "en", "s", 9, 1, "a", 2, 3), (4, text, "en", "s", 9, 1, "a", 2, 3),
            (None, "Only one sentence here", "en", None, None, 1, "b", 2, 3), (6, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES:
        assert stage(spark, df.limit(0), SF_SMALL).collect() == []
        df = stage(spark, df, SF_SMALL)
        if name != "encode":
            assert df.columns == [c.split()[0] for c in schema.split(", ")]
    got = defaultdict(list)
    for r in df.collect():
        got[r.doc_id].append(r.decoded)
    assert got == {4: [text], None: ["Only one sentence here"]}
