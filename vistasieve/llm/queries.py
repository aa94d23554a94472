"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from vistasieve.llm import (ann_forest, decontam_fm, lang_cnn, ngram_trie, orchard, packing, periodic_runs, sentence_spans, simhash_pivot,
                            suffix_dedup, unigram_pieces, url_trie, warc_writer)
from vistasieve.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# The rules of the url query (verdict, host, path).
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/"))

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH r(verdict, rhost, rpath) AS (VALUES {rules}),
     u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
     p AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
     f AS (SELECT n, rhost || rpath AS rule, verdict, row_number() OVER (
             PARTITION BY n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
           FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON f.n = p.n AND f.k = 1"""


@register("op6_url_filter", _url_sql())
def op6_url_filter(spark, sf):
    return url_trie.url_verdicts(table(spark, sf, "pages"), URL_RULES)


def _decontam_sql(width: int = 13, share: int = 20) -> str:
    words = rf"regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce({words}, []) AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE text IS NOT NULL),
     p AS (SELECT DISTINCT item, least(len(w), {width}) AS size, array_to_string(w[i:i + least(len(w), {width}) - 1], ' ') AS phrase
           FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {width} + 1, 1))) AS i FROM b WHERE len(w) > 0)),
     s AS (SELECT DISTINCT size FROM p),
     x AS (SELECT n, s.size, i, array_to_string(w[i:i + s.size - 1], ' ') AS phrase
           FROM (SELECT n, w, unnest(generate_series(1, len(w))) AS i FROM d) q, s WHERE i + s.size - 1 <= len(w)),
     h AS (SELECT x.n, x.i, x.size, p.item FROM x JOIN p ON p.phrase = x.phrase AND p.size = x.size),
     c AS (SELECT n, count(*) AS n_hit FROM (SELECT DISTINCT n, i + k AS at FROM (SELECT DISTINCT n, i, size FROM h), range({width}) AS t(k)
             WHERE k < size) GROUP BY n),
     f AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT n, item FROM h WHERE item IS NOT NULL)
           GROUP BY n)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * {share} >= len(d.w) AS contaminated
FROM d LEFT JOIN c ON c.n = d.n LEFT JOIN f ON f.n = d.n"""


@register("op8_decontaminate", _decontam_sql())
def op8_decontaminate(spark, sf):
    return decontam_fm.verdicts(decontam_fm.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@register("op9_simhash")
def op9_simhash(spark, sf):
    found = simhash_pivot.near_duplicates(table(spark, sf, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Sentences of a run. Runs of two, however short, coincide in clean documents (README).
SENTENCE_SPAN = 3


@register("op10_sentence_spans", sentence_spans.oracle(SENTENCE_SPAN))
def op10_sentence_spans(spark, sf):
    cut = sentence_spans.dedup_sentences(table(spark, sf, "documents").select("doc_id", "text"), SENTENCE_SPAN, counts=True)
    return cut.select("doc_id", "n_sentences", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def learned_language(docs: DataFrame) -> lang_cnn.ByteCNN | None:
    """The network trained on the documents that the contract lets it learn from."""
    return lang_cnn.fit(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)


@register("op3_language_id")
def op3_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    found = lang_cnn.predict(docs, learned_language(docs))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: SentencePiece model whose pieces and scores are used (a parameter of every function that needs it).
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def encode_and_decode(docs: DataFrame, model_file: str = PIECE_MODEL) -> DataFrame:
    """``doc_id``, ``ids``, ``n_fallback`` and ``decoded`` (the text the ids stand for) of each document."""
    vocab = unigram_pieces.load_vocabulary(model_file)
    return unigram_pieces.decode(unigram_pieces.encode(docs, vocab), vocab, keep=("ids", "n_fallback"))


@register("op5_sentencepiece")
def op5_sentencepiece(spark, sf):
    coded = encode_and_decode(table(spark, sf, "documents"))
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "n_fallback",
                        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op2_hash_prefix_forest")
def op2_hash_prefix_forest(spark, sf):
    return ann_forest.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def _warc_sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
     m AS (SELECT payload_digest, max(page_id) AS most FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT d.page_id, d.payload_bytes::BIGINT AS payload_bytes, d.payload_digest,
       CASE WHEN most IS NULL OR most = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN most <> page_id THEN most END AS refers_to
FROM d LEFT JOIN m USING (payload_digest)"""


@register("op7_warc", _warc_sql())
def op7_warc(spark, sf):
    read = warc_writer.read_warc(warc_writer.write_warc(table(spark, sf, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf):
    cut = suffix_dedup.remove_repeats(table(spark, sf, "documents"), 50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op1_lm_score")
def op1_lm_score(spark, sf):
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))
    scored = ngram_trie.score_texts(table(spark, sf, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


#: Tokeniser whose ids are packed (a parameter of the operator).
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@register("op11_packing")
def op11_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), WORD_TOKENIZER, limit=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in every tenth document by hash, the words behind a place repeat with a period from the hash."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    g = F.floor(F.col("h") / 10)
    docs = docs.withColumns({"a": F.when(F.col("n") > 0, g % F.col("n")).cast("int"), "g": g})
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf):
    found = periodic_runs.periodic_runs(planted_repeats(table(spark, sf, "documents")))
    # exact comparison of length / period by cross products; runs come by start and period, so the first of equals stays
    top = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
                   .otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("top", top)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _cluster_sql(clusters: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64) -> str:
    dims = f"range(1, {dim + 1})"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
 d{r} AS (SELECT v.n, v.vec_id, v.x, c.cluster, list_sum(list_transform({dims}, lambda i: (v.x[i] - c.y[i]) * (v.x[i] - c.y[i]))) AS far
         FROM v, c{r} c),
 a{r} AS (SELECT n, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(cluster, far * {clusters} + cluster) AS cluster,
           min(far) AS far FROM d{r} GROUP BY n)""")
        if r < rounds:
            steps.append(f"""
 s{r} AS (SELECT cluster, i, sum(x[i]) AS total, count(*) AS many FROM a{r}, {dims} AS t(i) GROUP BY cluster, i),
 m{r} AS (SELECT cluster, list(((total - ((total % many) + many) % many) // many)::BIGINT ORDER BY i) AS y FROM s{r} GROUP BY cluster),
 c{r + 1} AS (SELECT c.cluster, coalesce(m.y, c.y) AS y FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster)""")
    last = rounds
    return f"""
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x
           FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
 c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS y FROM
         (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {clusters})),{",".join(steps)},
 k AS (SELECT cluster, sum(far) AS cluster_inertia FROM a{last} GROUP BY cluster)
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.far::BIGINT AS distance, k.cluster_inertia::BIGINT AS cluster_inertia,
       (SELECT sum(far) FROM a{last})::BIGINT AS inertia, sha256(array_to_string(c.y, ',')) AS centroid_sha256
FROM a{last} a JOIN k ON k.cluster = a.cluster JOIN c{last} c ON c.cluster = a.cluster"""


@register("op13_orchard", _cluster_sql())
def op13_orchard(spark, sf):
    assigned, centroids = orchard.cluster(table(spark, sf, "embeddings"), clusters=16, rounds=3, dim=64, scale=64)
    return orchard.inertias(assigned, centroids).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
