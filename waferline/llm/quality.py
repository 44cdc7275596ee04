"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is described by counts over its
bytes and words and encoded by a small network. Gated attention weighs the encoded passages, the weights
being learned from labels of whole documents, and the weighted passage representation is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from waferline.llm.common import documents, fold, give_back, labelled_sample, text_blocks
from waferline.llm.words import LOWER, spans, word_hashes

PASSAGE_WORDS = 64
#: Labelled documents that the model is fitted on, half of each class as far as there are any.
FIT_ROWS = 4000
THRESHOLD = 0.7
ENCODED, GATE, EPOCHS = 24, 12, 160

_ASCII = np.arange(256)
#: Kinds of bytes whose shares describe a passage.
_KINDS = np.zeros((256, 13), np.float32)
_KINDS[:, 0] = ((_ASCII | 32) >= 97) & ((_ASCII | 32) <= 122) & (_ASCII < 128)
_KINDS[:, 1] = (_ASCII >= 65) & (_ASCII <= 90)
_KINDS[:, 2] = (_ASCII >= 48) & (_ASCII <= 57)
_KINDS[:, 3] = _ASCII >= 128
_KINDS[:, 4] = _ASCII == 10
for _i, _signs in enumerate((b".", b",", b"!?", b"|", b"#$%&*+=~^@", b"<>/\\", b"{}[]()_;", b"\"':-")):
    _KINDS[list(_signs), 5 + _i] = 1
_WORD_FEATURES = 11
FEATURES = _KINDS.shape[1] + _WORD_FEATURES + 2


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of many texts, and the texts' bounds in them; a text has one passage at least."""
    starts, ends, counts = spans(data, bounds)
    n = np.diff(counts)
    each = np.maximum(1, -(-n // PASSAGE_WORDS))
    cuts = np.concatenate([[0], np.cumsum(each)])
    out = np.zeros((cuts[-1], FEATURES), np.float32)
    if not len(starts):
        return out, cuts
    filled = np.flatnonzero(n > 0)
    number = np.arange(cuts[-1]) - np.repeat(cuts[:-1], each)
    first_word = (np.repeat(counts[:-1], each) + number * PASSAGE_WORDS)
    row = np.repeat(np.arange(len(n)), each)
    has = n[row] > 0
    low, size = first_word[has], np.minimum(PASSAGE_WORDS, counts[row + 1][has] - first_word[has])
    high = low + size
    # shares of kinds of bytes, from the first word's start to the next passage's
    a = starts[low]
    b = np.where(high < counts[row[has] + 1], starts[np.minimum(high, len(starts) - 1)], bounds[row[has] + 1])
    for kind in range(_KINDS.shape[1]):
        sums = np.concatenate([[0], np.cumsum(_KINDS[data, kind], dtype=np.float64)])
        out[has, kind] = (sums[b] - sums[a]) / (b - a)
    length = (ends - starts).astype(np.float64)
    lower = LOWER[data]
    hashes = word_hashes(lower, starts, ends)
    upper = ((data >= 65) & (data <= 90))
    uppers = np.concatenate([[0], np.cumsum(upper)])
    capital = upper[starts]
    shout = ((uppers[ends] - uppers[starts]) * 2 > ends - starts) & (ends - starts > 1)
    last = data[ends - 1]
    signs = (last < 128) & ~(((last | 32) >= 97) & ((last | 32) <= 122)) & ~((last >= 48) & (last <= 57))
    odd_end = signs & ~np.isin(last, np.frombuffer(b".,;:!?)\"'", np.uint8))
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    sign_word = signs & (length <= 2)
    passage = np.repeat(np.arange(len(low)), size)
    order = np.lexsort((hashes[_spread(low, size)], passage))
    h, p = hashes[_spread(low, size)][order], passage[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])])
    different = np.bincount(p[new], minlength=len(low))
    run = np.diff(np.append(np.flatnonzero(new), len(h)))
    most = np.zeros(len(low))
    np.maximum.at(most, p[new], run)

    def mean(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return (sums[high] - sums[low]) / size

    k = _KINDS.shape[1]
    average = mean(length)
    out[has, k : k + _WORD_FEATURES] = np.stack([
        average / 10, np.sqrt(np.maximum(mean(length**2) - average**2, 0)) / 10, mean(length <= 3), mean(length > 12),
        mean(capital), mean(shout), mean(odd_end), mean(same), mean(sign_word), different / size, most / size,
    ], axis=1)
    out[has, -2] = np.log1p(size) / np.log1p(PASSAGE_WORDS)
    out[:, -1] = np.repeat(np.log1p(n) / 10, each)
    out[cuts[:-1][np.setdiff1d(np.arange(len(n)), filled)], :] = 0
    return out, cuts


def _spread(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


@dataclass
class Attention:
    """Encoder, gated attention and scorer; features are centred and scaled first."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, cuts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        view, gate = np.tanh(h @ w["view"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        energy = (view * gate) @ w["attend"]
        bag = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        top = np.maximum.reduceat(energy, cuts[:-1])
        raw = np.exp(energy - top[bag])
        share = raw / np.add.reduceat(raw, cuts[:-1])[bag]
        z = np.add.reduceat(h * share[:, None], cuts[:-1])
        score = 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_bias"], -30, 30)))
        return {"h": h, "view": view, "gate": gate, "share": share, "bag": bag, "z": z, "score": score}

    def scores(self, features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        if len(cuts) < 2:
            return np.empty(0)
        return self.forward((features - self.mean) / self.scale, cuts)["score"].astype(np.float64)


def fit(sample: list[tuple[str, int]], sizes: dict[int, int], seed: int = 11) -> Attention:
    """Train on whole-document labels with Adam; the classes weigh as they stand in the table."""
    rng = np.random.default_rng(seed)
    parts = [passages(data, bounds) for _, _, data, bounds in text_blocks(pa.array([t for t, _ in sample], pa.string()))]
    x = np.concatenate([p for p, _ in parts]) if parts else np.zeros((0, FEATURES), np.float32)
    cuts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(c) for _, c in parts]))]) if parts else np.zeros(1, np.int64)
    y = np.array([c for _, c in sample], np.float64)
    shapes = {"encode": (FEATURES, ENCODED), "encode_bias": (ENCODED,), "view": (ENCODED, GATE), "gate": (ENCODED, GATE), "attend": (GATE,), "score": (ENCODED,), "score_bias": ()}
    weights = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "encode_bias" else np.zeros(s)).astype(np.float64) for k, s in shapes.items()}
    model = Attention(x.mean(axis=0) if len(x) else np.zeros(FEATURES), x.std(axis=0) + 1e-2 if len(x) else np.ones(FEATURES), weights)
    if len(set(y.tolist())) < 2:  # nothing to tell apart: the share of the class there is, for every text
        good, bad = sizes.get(1, 0) + 1, sizes.get(0, 0) + 1
        weights["score"][:] = 0
        weights["score_bias"] = np.array(np.log(good / bad))
        return model
    x = ((x - model.mean) / model.scale).astype(np.float64)
    weight = np.where(y == 1, sizes.get(1, 0) / max((y == 1).sum(), 1), sizes.get(0, 0) / max((y == 0).sum(), 1))
    weight /= weight.sum()
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, EPOCHS + 1):
        f = model.forward(x, cuts)
        slope = weight * (f["score"] - y)
        grads = {"score": f["z"].T @ slope, "score_bias": slope.sum()}
        dz = (slope[:, None] * weights["score"])[f["bag"]]
        dh = dz * f["share"][:, None]
        along = (dz * f["h"]).sum(axis=1)
        mean = np.add.reduceat(along * f["share"], cuts[:-1])[f["bag"]]
        energy = f["share"] * (along - mean)
        both = energy[:, None] * weights["attend"]
        grads["attend"] = (f["view"] * f["gate"]).T @ energy
        dview = both * f["gate"] * (1 - f["view"] ** 2)
        dgate = both * f["view"] * f["gate"] * (1 - f["gate"])
        grads["view"], grads["gate"] = f["h"].T @ dview, f["h"].T @ dgate
        dh = (dh + dview @ weights["view"].T + dgate @ weights["gate"].T) * (1 - f["h"] ** 2)
        grads["encode"], grads["encode_bias"] = x.T @ dh, dh.sum(axis=0)
        rate = 0.02 * min(1.0, 2 * (1 - step / (EPOCHS + 1)))
        for k, g in grads.items():
            g = g + (1e-5 * weights[k] if k != "score_bias" else 0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def score(docs: DataFrame, model: Attention, *more: str) -> DataFrame:
    """doc_id, text, the columns ``more`` as they are, and ``score`` between 0 and 1 of every whole text (null as empty)."""
    rows = documents(docs, *more)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(*passages(data, bounds)) for _, _, data, bounds in text_blocks(batch.column(1), 1 << 21)]
            if scores:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(apply, StructType([*rows.schema.fields]).add("score", DoubleType()))


def learnable() -> Column:
    """Rows whose labels may be learned from."""
    return fold(4) != 2


def classify(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Labels of held-out rows, null labels, labels other than 0 and 1, and labels without a document are not
    used; of an id labelled twice the larger label counts. Null and empty texts are one empty passage.
    Without labels of both classes every text gets the share of good labels. Repeated rows are scored each;
    the same text has the same score. An empty table gives no rows.
    """
    model = fit(*labelled_sample(docs, labels, "quality", learnable(), limit))
    give_back()
    scored = score(docs, model)
    return scored.select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
