import random

import numpy as np
import pytest

from vistasieve.llm import unigram_pieces as up

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocab():
    return up.load_vocabulary(MODEL)


@pytest.fixture(scope="module")
def library(tmp_path_factory):
    """The library's own unigram model over the same pieces: the file with its model type switched to unigram."""
    import sentencepiece

    raw = open(MODEL, "rb").read()
    at = raw.rfind(b"\x18\x02")
    path = tmp_path_factory.mktemp("spm") / "unigram.model"
    path.write_bytes(raw[:at] + b"\x18\x01" + raw[at + 2:])
    return sentencepiece.SentencePieceProcessor(model_file=str(path))


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choice(b"ab\xff c") for _ in range(rng.randint(1, 6))) for _ in range(400)})
    base, check, value = up.double_array(keys)

    def find(key):
        state = 0
        for b in key:
            nxt = base[state] + b + 1
            if check[nxt] != state:
                return -1
            state = nxt
        return value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    others = [bytes(rng.choice(b"ab\xff cd") for _ in range(rng.randint(0, 7))) for _ in range(2000)]
    assert all(find(k) == -1 for k in others if k not in set(keys))


def test_against_the_library(vocab, library, documents):
    """Same pieces nearly everywhere; where the library takes other pieces, ours score at least as high."""
    viterbi, score = up.Viterbi(vocab), {i: s for _, s, i in vocab.pieces}
    units = {u for _, t in documents if t for u in t.split()} | {"naïve", "😀", "\x00\x01", "日本語", "a\u00a0b"}
    same = 0
    for u in units:
        ours, theirs = viterbi.best_path(b" " + u.encode()), library.encode(u)
        same += ours == theirs
        assert sum(score.get(i, viterbi.unknown) for i in ours) >= sum(score.get(i, viterbi.unknown) for i in theirs)
    assert same > 0.98 * len(units)
    for t in ("a  b   c ", " x", "日本語 テキスト", "tab\tnew\nline"):
        assert viterbi.encode(t.encode()).tolist() == library.encode(t)


def test_best_path_is_optimal(vocab):
    small = up.Vocabulary([(p, float(s), 300 + i) for i, (p, s) in enumerate(
        [(b" ", -5), (b"a", -2), (b"b", -2), (b" a", -3), (b"ab", -3), (b"aba", -4.5), (b"ba", -3.5), (b"\xc3\xa9", -1)])],
        list(range(256)), *up.double_array([b" ", b"a", b"b", b" a", b"ab", b"aba", b"ba", b"\xc3\xa9"]))
    viterbi, score = up.Viterbi(small), {i: s for _, s, i in small.pieces}
    table = {p: s for p, s, _ in small.pieces}

    def best(u):
        return 0.0 if not u else max([table[u[:k]] + best(u[k:]) for k in range(1, len(u) + 1) if u[:k] in table]
                                     + [-15.0 + best(u[1:])])
    for u in (b" abab", b" aaabba", b" xaba", b" zz", b" b"):
        assert sum(score.get(i, -15.0) for i in viterbi.best_path(u)) == best(u)


def test_many_units_at_once(vocab, documents):
    """The array search gives the same paths as the search of single units."""
    viterbi = up.Viterbi(vocab)
    units = sorted({b" " + u for _, t in documents if t for u in up.units_of(t.encode())} | {b" ", b"   a", " ▁é😀x".encode(), b" \xff\xe2"})
    units = [u for u in units if len(u) < 300][:6000]
    assert [np.frombuffer(x, np.int32).tolist() for x in viterbi.best_paths(units)] == [viterbi.best_path(u) for u in units]


def test_round_trip(spark, vocab, documents, docs_df):
    odd = [(200_000, "▁ marker ▁▁ in text"), (200_001, "  lead and trail  "), (200_002, " "), (200_003, "<0x41> <s> </s>"),
           (200_004, "q" * 30_000), (None, "no id"), (None, "no id")]
    df = docs_df.select("doc_id", "text", "n").union(spark.createDataFrame([(*r, 1) for r in odd], "a long, b string, n int"))
    coded = up.encode(df, vocab)
    got = sorted(((r.doc_id, r.decoded) for r in up.decode(coded, vocab).collect()), key=str)
    assert got == sorted(documents + odd, key=str)
    by_id = {r.doc_id: r for r in coded.collect()}
    assert by_id[100_003].ids is None and by_id[100_004].ids == []
    assert by_id[200_000].n_fallback == 9
    assert up.encode(df.limit(0), vocab).collect() == []
