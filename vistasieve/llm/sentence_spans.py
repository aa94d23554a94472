"""Substring dedup by sliding sentence spans.

Every run of ``span`` consecutive sentences is hashed (XXH3, 128 bits); the hashes are joined over the
whole corpus, and a sentence goes when any run that covers it is a repeat, that is, not the first one by (document id,
position). A sentence ends after ``.``, ``!`` or ``?`` with white space behind it, or after a line feed, and keeps the
white space that follows, so the kept sentences concatenate to the cut text. Runs compare sentences without the white
space around them. A text of fewer than ``span`` sentences is one run, and shorter stretches that hold at least ``words``
words are runs too. A passage that is glued into its neighbours' sentences loses its first and last sentence to them, so
``span`` and ``words`` are small: what is left of it is found if it is two whole sentences, or one of ``WORDS`` words. The
parts of sentences at its edges stay, and so does a passage without such a whole sentence.

Only hashes seen twice are joined back; adaptive execution splits a hot passage in that join, and counting it is
pre-aggregated on the map side.

Defined cases: null texts stay null, empty and blank texts stay as they are, all without sentences; null ids come
first; rows that repeat an id, or a whole row, are rows of their own, told apart by their place in the written table;
equal runs of one row are ordered by place; a very long text is cut whole in one task, in a few times its size; an empty
table gives an empty result; all other columns pass through, whatever their names (but ``n_sentences`` and
``n_removed``, which ``counts`` adds, replace columns of these names).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import slices, with_fields, written

_WS = r" \t\n\x0B\f\r"
#: One sentence with the white space around it (the same expression in Java and RE2).
SENTENCE = rf"[{_WS}]*[^{_WS}][\s\S]*?(?:[.!?][{_WS}]+|\n[{_WS}]*|\z)"
WORDS = 12  # words that make a run of fewer sentences
BLANKS = " \t\n\x0b\f\r"  # what is trimmed


_BREAK = re.compile(rb"[.!?][ \t\n\x0B\f\r]+|\n[ \t\n\x0B\f\r]*")
_BLANKS = b" \t\n\x0b\f\r"


def sentences(body: bytes | None) -> list[bytes]:
    """The sentences of a text (matches of ``SENTENCE``), found by searching for their ends; none in a blank text."""
    out, start = [], 0
    if not body or not (lead := len(body) - len(body.lstrip(_BLANKS))) < len(body):
        return out
    first = lead
    while start < len(body):
        end = m.end() if (m := _BREAK.search(body, first + 1)) else len(body)
        out.append(body[start:end])
        start = first = end
    return out


def runs_of(parts: list[bytes], span: int, words: int) -> list[tuple[int, int, bytes]]:
    """The runs of a text: first sentence, number of sentences, and the trimmed sentences, one a line."""
    keys = [p.strip(_BLANKS) for p in parts]
    upto = np.cumsum([0, *(len(k.split()) for k in keys)]).tolist()
    least = min(span, len(keys))
    return [(i, k, b"\n".join(keys[i:i + k])) for i in range(len(keys)) for k in range(1, min(span, len(keys) - i) + 1)
            if k == least or upto[i + k] - upto[i] >= words]


def sentence_runs(rows: DataFrame, span: int, words: int) -> DataFrame:
    """``id``, ``n``, ``at`` and ``many`` (the run's first sentence and their number) and the 128-bit hash (h1, h2) of
    each run of each row's ``body``."""
    def split(batches):
        for piece in slices(batches, "body", 4 << 20):
            runs = [runs_of(sentences(b), span, words) for b in piece.column("body").to_pylist()]
            row = pa.array(np.repeat(np.arange(len(runs)), [len(r) for r in runs]))
            at, many, lines = zip(*(x for r in runs for x in r)) if len(row) else ((), (), ())
            digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id").take(row), piece.column("n").take(row), pa.array(at, pa.int32()), pa.array(many, pa.int32()),
                 pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())], names=["id", "n", "at", "many", "h1", "h2"])

    return rows.select("id", "n", "body").mapInArrow(
        split, with_fields(rows, "id", "n bigint, at int, many int, h1 bigint, h2 bigint"))


def repeated_runs(rows: DataFrame, span: int, words: int) -> DataFrame:
    """``n`` and ``starts``: per row, its runs (first sentence, number) that repeat an earlier run."""
    runs = sentence_runs(rows, span, words)
    place = F.struct("id", "n", "at")
    first = runs.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(place).alias("first")).where("c > 1").drop("c")
    first = written(first, "sentence-repeats")
    again = runs.join(first, ["h1", "h2"]).where(place > F.col("first"))
    return again.groupBy("n").agg(F.collect_list(F.struct("at", "many")).alias("starts"))


def dedup_sentences(docs: DataFrame, span: int = 2, id_col: str = "doc_id", text: str = "text",
                    counts: bool = False, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` with ``text`` cut; ``counts`` adds ``n_sentences`` and ``n_removed``."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = written(docs.select(row, F.monotonically_increasing_id().alias("n")), "sentence-rows")
    body, ident = F.col("row").getField(text).cast("binary"), F.col("row").getField(id_col)
    starts = repeated_runs(rows.select(ident.alias("id"), "n", body.alias("body")), span, words)

    def cut(batches):
        for piece in slices(batches, "body", 4 << 20):
            texts, total, removed = [], [], []
            for text_, begin in zip(piece.column("body").to_pylist(), piece.column("starts").to_pylist()):
                parts = sentences(text_)
                gone = {i for run in begin or () for i in range(run["at"], run["at"] + run["many"])}
                texts.append(b"".join(p for i, p in enumerate(parts) if i not in gone) if gone else text_)
                total.append(len(parts))
                removed.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
                 pa.array(removed, pa.int64())], names=["row", "cut", "n_sentences", "n_removed"])

    joined = rows.join(starts, "n", "left").select("row", body.alias("body"), "starts")
    out = joined.mapInArrow(cut, with_fields(rows, "row", "cut string, n_sentences bigint, n_removed bigint"))
    added = ["n_sentences", "n_removed"] if counts else []
    return out.select(*((F.col("cut") if c == text else F.col("row").getField(c)).alias(c)
                        for c in docs.columns if c not in added), *added)


def oracle(span: int, words: int = WORDS) -> str:
    """DuckDB statement: doc_id, n_sentences, n_removed and the cut text's SHA-256 of ``documents``."""
    pattern = SENTENCE.replace("'", "''")
    return rf"""
WITH s AS (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS s FROM documents),
     u AS (SELECT doc_id, unnest(generate_series(0, len(s) - 1)) AS pos, s FROM s WHERE len(s) > 0),
     r AS (SELECT doc_id, pos, many, least({span}, len(s)) AS full_run, array_to_string(list_transform(s[pos + 1:pos + many],
             lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), chr(10)) AS run
           FROM u, range(1, {span} + 1) AS t(many) WHERE pos + many <= len(s)),
     k AS (SELECT doc_id, pos, many, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM r
           WHERE many = full_run OR len(regexp_extract_all(run, '[^ \t\n\x0B\f\r]+')) >= {words}),
     g AS (SELECT DISTINCT doc_id, pos + j AS i FROM k, range({span}) AS t(j) WHERE nth > 1 AND j < many),
     c AS (SELECT g.doc_id, list(g.i) AS gone FROM g JOIN s ON s.doc_id = g.doc_id WHERE g.i < len(s.s) GROUP BY 1),
     f AS (SELECT s.doc_id, coalesce(len(s.s), 0) AS n_sentences, coalesce(len(c.gone), 0) AS n_removed,
             CASE WHEN c.gone IS NULL THEN s.text ELSE array_to_string(list_transform(list_filter(
               generate_series(0, len(s.s) - 1), lambda i: NOT list_contains(c.gone, i)), lambda i: s.s[i + 1]), '') END AS t
           FROM s LEFT JOIN c ON c.doc_id = s.doc_id)
SELECT doc_id, n_sentences::BIGINT AS n_sentences, n_removed::BIGINT AS n_removed, sha256(t) AS kept_sha256 FROM f"""
