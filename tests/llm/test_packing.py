import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vistasieve.llm import packing as pk
from vistasieve.llm.queries import op11_packing

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def cheapest(at, penalty, limit, free):
    """Least cost by trying every start of every window."""
    cost = [0]
    for j in range(1, len(at)):
        cost.append(penalty[j] + min(cost[i] + (0 if at[j] - at[i] in free else limit - at[j] + at[i])
                                     for i in range(j) if at[j] - at[i] <= limit))
    return cost[-1]


def test_cuts_are_the_cheapest():
    r = random.Random(1)
    for _ in range(300):
        limit, n = r.choice([8, 16, 37]), r.randint(1, 60)
        at = np.cumsum([0] + [r.randint(1, limit if r.random() < 0.2 else 4) for _ in range(n)])
        penalty = np.array([0] + [r.choice([0, 1, 3]) for _ in range(n)])
        free = {1, 2, 4, 8} if r.random() < 0.7 else set()
        cuts = pk.best_cuts(at, penalty, limit, free)
        assert cuts[-1] == n and cuts == sorted(set(cuts))
        sizes = np.diff(np.r_[0, at[cuts]])
        assert sizes.max() <= limit
        cost = sum(0 if s in free else limit - s for s in sizes.tolist()) + int(penalty[cuts].sum())
        assert cost == cheapest(at.tolist(), penalty.tolist(), limit, free)


def test_boundaries_leave_no_gap():
    at, penalty = pk.boundaries(np.array([5, 1000, 1001]), np.array([5, 300, 301]), 1500, 256)
    assert at.tolist()[0] == 0 and at.tolist()[-1] == 1500 and np.diff(at).min() >= 1 and np.diff(at).max() <= 16
    cost = dict(zip(at.tolist(), penalty.tolist()))
    assert cost[5] == cost[1000] == cost[1001] == 0 and cost[300] == cost[301] == pk.SENTENCE and cost[700] == pk.INNER


def ids_of(coder, text):
    units = pk.split_units([text.encode()])
    ids, many = coder(units.names.to_pylist())
    first = np.cumsum(many) - many
    return [i for n in units.number for i in ids[first[n]:first[n] + many[n]].tolist()]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\x0b\x85　'sS.,!\x01é́<|>endoftextAZ$#ÀÉÑßÿ×÷µªÃ¿İŉΣς\u0301\u0308"))))
def test_words_give_the_ids_of_the_whole_text(text):
    coder = pk.word_ids(open(FILE, encoding="utf-8").read())
    assert ids_of(coder, text) == coder.whole.encode(text, add_special_tokens=False).ids


def test_words_are_forgotten_beyond_a_number(tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "MAX_KNOWN", 10)
    coder = pk.WordIds(open(FILE, encoding="utf-8").read())
    for _ in range(3):
        text = "One, two TWO!? l'eau 3x <|endoftext|> <|ENDOFTEXT|> a<|endoftext|> A.B a.b. a\x01b \x01 [] É. ÀB! it's" + " w1 w2 w3" * 9 + " ÀÉÑßÿ ÇA!! é\u0301, a!\u0301 ×÷ µ ª ΑΣ İÑ Ñİ ÿ?! Ã"
        assert ids_of(coder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def check(pieces, texts, tokenizer, limit):
    """Every id in exactly one piece, sequences gapless; returns the tokens and the padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert by_doc.keys() == texts.keys()
    for key, found in by_doc.items():
        ids = tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [1]
        found.sort(key=lambda p: p["start"])
        at = 0
        for p in found:
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            part = np.array(ids[at:at + p["length"]], "<u4").tobytes()
            assert p["ids"] == part if "ids" in p else p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(ids)
    tokens = padding = 0
    for found in by_seq.values():
        found.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in found] == np.r_[0, np.cumsum([p["length"] for p in found])].tolist()[:-1]
        size = sum(p["length"] for p in found)
        assert size <= limit
        tokens, padding = tokens + size, padding + (0 if size & (size - 1) == 0 else limit - size)
    return tokens, padding


def test_query_on_the_table(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r.asDict() for r in op11_packing(spark, sf).collect()]
    tokens, padding = check(rows, texts, tokenizer, 2048)
    assert padding < 0.01 * tokens


@pytest.mark.parametrize("block", [300, 20_000, 16 << 20])
def test_odd_rows_blocks_and_long_texts(spark, docs_df, documents, tokenizer, block):
    df = docs_df.coalesce(2)
    rows = [r.asDict() for r in pk.pack(df, FILE, limit=128, block_bytes=block).collect()]
    tokens, padding = check(rows, dict(documents), tokenizer, 128)
    assert padding < (0.1 if block > 300 else 0.3) * tokens  # penalties weigh much in so short windows
    assert rows == [r.asDict() for r in pk.pack(df, FILE, limit=128, block_bytes=block).collect()]


def test_order_is_kept_and_cuts_lie_behind_sentences(spark, tokenizer):
    text = " ".join(f"this is sentence number {i} of the text ." for i in range(200))
    df = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string").coalesce(1)
    pieces = sorted((r.asDict() for r in pk.pack(df, FILE, limit=512).collect()), key=lambda p: (p["sequence_id"], p["offset"]))
    assert [(p["doc_id"], p["start"]) for p in pieces] == sorted((p["doc_id"], p["start"]) for p in pieces)
    stop = tokenizer.encode(".", add_special_tokens=False).ids[0]
    ends = [np.frombuffer(p["ids"], "<u4")[-1] for p in pieces]
    assert set(ends) == {1, stop}


def test_null_ids_repeats_and_no_rows(spark, tokenizer):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None), (3, "")], "doc_id long, text string").coalesce(1)
    rows = pk.pack(df, FILE, limit=4).collect()
    assert sorted(r.doc_tokens for r in rows) == [1, 1, 3, 3] or sum(r.length for r in rows) == 8
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pk.pack(df.limit(0), FILE).collect() == []


def test_texts_longer_than_a_block(spark, tokenizer):
    texts = {1: "x" * 5000, 2: "word " * 3000, 3: "\n" * 4000, 4: "One two three. " * 500, 5: None, 6: " " * 999 + "a"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    check([r.asDict() for r in pk.pack(df, FILE, limit=64, block_bytes=1000).collect()], texts, tokenizer, 64)
