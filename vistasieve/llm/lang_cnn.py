"""Language identification with a byte convolutional network.

Texts are cut into fixed windows of bytes. Filters of several widths over one-hot bytes (so a filter is a table of byte
weights per offset), max pooling over each window, and a softmax layer give a distribution per window; a text's
distribution is the mean over all its windows, weighted by their bytes. The network is trained with Adam in numpy on the
driver, on at most ``per_label`` labelled documents of each label and ``WINDOWS_EACH`` windows of each, drawn by hash;
what the driver holds is bounded by that and by the labels. Prediction runs on all windows of whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text when there is nothing to
learn from; labels that are null are not learned; of equally likely labels the first in order wins; a very long text is judged in all its
windows, a bounded number at a time; repeated rows are judged one by one; an empty table gives an empty result; columns other than the id, the text and (for training) the label are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistasieve.llm.common import offsets, slices, utf8, with_fields

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8        # of each width
PER_LABEL = 800    # bound on training documents of a label
WINDOWS_EACH = 2
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(body: bytes | None) -> bool:
    return bool(body) and (bool(_ASCII_LETTER.search(body)) or any(c.isalpha() for c in body.decode("utf-8", "replace")))


@dataclass
class ByteCNN:
    labels: list[str]
    tables: list[np.ndarray]  # for each width w: (w, 256, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    out_bias: np.ndarray

    def convolve(self, windows: np.ndarray, table: np.ndarray) -> np.ndarray:
        w, span = len(table), windows.shape[1] - len(table) + 1
        acc = np.take(table[0], windows[:, :span], axis=0)
        for j in range(1, w):
            acc += np.take(table[j], windows[:, j:j + span], axis=0)
        return acc

    def features(self, windows: np.ndarray) -> np.ndarray:
        pooled = [self.convolve(windows, t).max(axis=1) for t in self.tables]
        return np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [self.features(windows[i:i + 32]) for i in range(0, len(windows), 32)]
        return softmax(np.concatenate(parts) @ self.dense + self.out_bias)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, target: np.ndarray, labels: list[str], epochs: int = 3, batch: int = 64,
          rate: float = 0.02, seed: int = 7, min_steps: int = 200) -> ByteCNN:
    """Adam on cross-entropy; windows are cut at random lengths too, so that short texts are learned. A small sample
    is passed over more often, for ``min_steps`` steps at least."""
    epochs = max(epochs, -(-min_steps * batch // len(windows)))
    rng = np.random.default_rng(seed)
    n_features = FILTERS * len(WIDTHS)
    model = ByteCNN(
        labels, [(rng.standard_normal((w, 256, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS],
        np.zeros(n_features, np.float32), (rng.standard_normal((n_features, len(labels))) * 0.3).astype(np.float32),
        np.zeros(len(labels), np.float32))
    params = [*model.tables, model.bias, model.dense, model.out_bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            x, y = windows[order[at:at + batch]].copy(), target[order[at:at + batch]]
            for row, cut in zip(x, rng.integers(24, 2 * WINDOW, len(x))):
                row[cut:] = 0
            maps = [model.convolve(x, t) for t in model.tables]
            peaks = [a.argmax(axis=1) for a in maps]
            pooled = np.concatenate([a.max(axis=1) for a in maps], axis=1) + model.bias
            hidden = np.maximum(pooled, 0)
            d_out = softmax(hidden @ model.dense + model.out_bias)
            d_out[np.arange(len(y)), y] -= 1
            d_out /= len(y)
            d_pool = (d_out @ model.dense.T) * (pooled > 0)
            grads = []
            for i, (t, peak) in enumerate(zip(model.tables, peaks)):
                g, part = np.zeros_like(t), d_pool[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(len(t)):
                    np.add.at(g[j], (np.take_along_axis(x, peak + j, axis=1), np.arange(FILTERS)), part)
                grads.append(g)
            grads += [d_pool.sum(axis=0), hidden.T @ d_out, d_out.sum(axis=0)]
            step += 1
            for p, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-6)
    return model


def windows_of(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as rows (the last one of a text filled up with zeros), and the number of each text."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    counts = -(-sizes // WINDOW)
    out = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    flat, at = out.ravel(), offsets(counts) * WINDOW
    for b, start in zip(bodies, at.tolist()):
        flat[start:start + len(b)] = np.frombuffer(b, np.uint8)
    return out, counts


def fit(docs: DataFrame, where: Column, id_col: str = "doc_id", text: str = "text", label: str = "lang",
        per_label: int = PER_LABEL) -> ByteCNN | None:
    """Train on a bounded sample of the labelled rows that ``where`` admits; None when there are none."""
    rows = docs.where(where).select(F.col(label).alias("label"), F.col(text).cast("binary").alias("body"),
                                    F.xxhash64(F.col(id_col)).alias("h"))
    rows = rows.where("label is not null and length(body) > 0")
    count = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not count:
        return None
    share = F.create_map(*(F.lit(x) for k, n in count.items() for x in (k, min(1.0, 1.5 * per_label / n))))
    drawn = rows.where(F.pmod("h", F.lit(1_000_003)) < 1_000_003 * share[F.col("label")])
    spots = F.array(*(F.pmod(F.xxhash64("h", F.lit(i)), F.ceil(F.length("body") / WINDOW)) for i in range(WINDOWS_EACH)))
    cut = drawn.select("label", "h", F.transform(spots, lambda s: F.substring(
        "body", (s * WINDOW + 1).cast("int"), F.lit(WINDOW))).alias("cuts"))
    sample = sorted(map(tuple, cut.limit(3 * per_label * len(count)).collect()), key=lambda r: (r[0], r[1]))
    labels, bodies, target, kept = sorted(count), [], [], dict.fromkeys(count, 0)
    for name, _, cuts in sample:
        kept[name] += 1
        good = [bytes(c) for c in dict.fromkeys(map(bytes, cuts)) if has_letter(bytes(c))]
        bodies += good if kept[name] <= per_label else []
        target += [labels.index(name)] * len(good) if kept[name] <= per_label else []
    if not bodies:
        return None
    return train(windows_of(bodies)[0], np.array(target), labels)


def predict(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``lang_pred`` and ``score`` (the mean probability of that label)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        net = sent.value
        for piece in slices(batches, "body", 4 << 20):
            bodies = piece.column(1).to_pylist()
            known = [i for i, b in enumerate(bodies) if net and has_letter(b)]
            label, score = [UNKNOWN] * len(bodies), [0.0] * len(bodies)
            if known:
                windows, counts = windows_of([bodies[i] for i in known])
                size = np.count_nonzero(windows, axis=1) + 1e-9
                p = np.add.reduceat(net.probabilities(windows) * size[:, None], offsets(counts)[:-1], axis=0)
                p /= np.add.reduceat(size, offsets(counts)[:-1])[:, None]
                for i, best, top in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    label[i], score[i] = net.labels[best], round(min(1.0, top), 6)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(label), pa.array(score, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])

    return utf8(docs, id_col, text).mapInArrow(judge, with_fields(docs, id_col, "lang_pred string, score double"))
