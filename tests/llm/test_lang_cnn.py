import numpy as np
from pyspark.sql import functions as F

from vistasieve.llm import lang_cnn as lc
from vistasieve.llm.queries import op3_language_id

from .conftest import SF_SMALL


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")
    got = op3_language_id(spark, SF_SMALL).join(truth, "doc_id").collect()
    assert len(got) == truth.count()
    held = [r for r in got if r.held_out and r.lang and len(r.text.split()) > 3]
    assert len(held) > 20
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_convolution_is_one_hot_convolution():
    rng = np.random.default_rng(0)
    model = lc.train(rng.integers(0, 256, (20, lc.WINDOW), dtype=np.uint8), rng.integers(0, 2, 20), ["a", "b"], epochs=1)
    x = rng.integers(0, 256, (3, lc.WINDOW), dtype=np.uint8)
    onehot = np.eye(256, dtype=np.float32)[x]
    for t in model.tables:
        want = sum(onehot[:, j:lc.WINDOW - len(t) + 1 + j] @ t[j] for j in range(len(t)))
        assert np.allclose(model.convolve(x, t), want, atol=1e-5)


def forward(model, body):
    """Label and score of a text by plain loops: windows, filters, maxima, softmax, mean weighted by bytes."""
    sums, total = np.zeros(len(model.labels)), 0.0
    for at in range(0, len(body), lc.WINDOW):
        window = body[at:at + lc.WINDOW]
        padded = list(window) + [0] * (lc.WINDOW - len(window))
        features = []
        for table in model.tables:
            width, filters = len(table), table.shape[2]
            for f in range(filters):
                features.append(max(sum(float(table[j][padded[i + j]][f]) for j in range(width)) for i in range(lc.WINDOW - width + 1)))
        hidden = [max(0.0, x + float(b)) for x, b in zip(features, model.bias)]
        logits = [sum(h * float(w) for h, w in zip(hidden, model.dense[:, k])) + float(model.out_bias[k]) for k in range(len(model.labels))]
        top = max(logits)
        e = [np.exp(x - top) for x in logits]
        weight = sum(1 for b in padded if b) + 1e-9
        sums += weight * np.array(e) / sum(e)
        total += weight
    best = int(np.argmax(sums))
    return model.labels[best], sums[best] / total


def test_predictions_equal_plain_loops(spark, documents):
    """The whole way from text to label, on texts of less than a window, of several, and with odd bytes."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog " * 8, "en"), ("der hund und die katze " * 8, "de")] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lc.fit(df, F.lit(True))
    texts = sorted({t for _, t in documents if t and lc.has_letter(t.encode())}, key=len)
    texts = texts[:6] + [t for t in texts if 300 < len(t) < 900][:4] + ["x\x00y", "ß"]
    got = lc.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert len(got) == len(texts)
    for r in got:
        label, score = forward(model, texts[r.doc_id].encode())
        assert r.lang_pred == label and abs(r.score - score) < 1e-4


def test_defined_cases(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog " * 8, "en"), ("der hund und die katze " * 8, "de")] * 40)]
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !?", "de"), (903, "der hund", None), (None, "the cat", "en"),
           (903, "der hund", None), (904, "the cat and the dog " * 5000, None)]
    df = spark.createDataFrame([(*r, "s") for r in rows + odd], "doc_id long, text string, lang string, score string")
    model = lc.fit(df, F.lit(True))
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in lc.predict(df, model).where("doc_id >= 900 or doc_id is null")
                  .collect()), key=str)
    assert [(d, p) for d, p, _ in got] == [(900, "und"), (901, "und"), (902, "und"), (903, "de"), (903, "de"), (904, "en"),
                                           (None, "en")]
    assert [s for d, p, s in got if p == "und"] == [0.0] * 3
    assert lc.fit(df.limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in lc.predict(df, None).collect()} == {"und"}
    assert lc.predict(df.limit(0), model).collect() == []
