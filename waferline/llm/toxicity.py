"""Toxicity by weak supervision.

Voters are lexicon entries (a fixed list of insults, and words and word beginnings that labelled toxic
documents use and others don't) and patterns over them. A generative label model estimates from the votes
alone how often each voter is right, and which voters repeat each other, and gives each document of the
sample a posterior. A linear classifier over terms is trained on the posteriors, and scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from waferline.llm.common import documents, fold, give_back, labelled_sample, list_blocks, text_blocks
from waferline.llm.words import mix, raw_hashes, spans

#: Labelled documents that the models are fitted on, half of each class as far as there are any.
FIT_ROWS = 6000
THRESHOLD = 0.7
#: Lengths in bytes of the word beginnings that count as terms, beside the whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
MINED_VOTERS = 96
TERMS = 3000
#: A term is mined if chance would bring fewer such terms than this, among those as frequent.
FALSE_FINDS = 0.02
#: ... and if so large a share of the texts it stands in is toxic.
PURE = 0.97
#: Voters whose errors correlate more than this count as repeating each other.
CORRELATED = 0.2
#: Fixed: insults and slurs that vote without being mined.
LEXICON = (
    "asshole bastard bitch clown cretin disgusting dumbass filth fool freak garbage idiot imbecile jerk "
    "loser moron parasite pathetic scum stupid trash ugly vermin worthless "
    "abschaum arschloch dummkopf idiotin mistkerl trottel versager widerlich wertlos "
    "abruti connard cretine idiote imbecile ordure salaud stupide "
    "basura estupido idiota imbecil inutil payaso tonto"
).split()

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_APART[128:] = False


def _plain(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the capital Latin-1 letters."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[lead + 1]
    out[lead[(tail >= 0x80) & (tail < 0x9F) & (tail != 0x97)] + 1] += 0x20
    return out


def term_hashes(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, row) of all terms of many texts: words of letters and digits, and their beginnings, kind by kind."""
    plain = _plain(data)
    starts, ends, counts = spans(plain, bounds, _APART)
    if not len(starts):
        return
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(counts))
    yield mix(raw_hashes(plain, starts, ends) + np.uint64(77)), row
    for length in BEGINNINGS:
        long_ = ends - starts > length
        yield mix(raw_hashes(plain, starts[long_], starts[long_] + length) + np.uint64(length)), row[long_]


def _word_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return next(term_hashes(data, np.array([0, len(data)])))[0][0]


class TermIndex:
    """Finds which of a few chosen terms stand in each text."""

    def __init__(self, terms: np.ndarray):
        self.order = np.argsort(terms)
        self.terms = terms[self.order]
        self.marks = np.zeros(1 << 16, bool)
        self.marks[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def present(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, term number) pairs, by row."""
        rows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for hashes, row in term_hashes(data, bounds):
            if not len(self.terms):
                break
            maybe = np.flatnonzero(self.marks[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
            hit = self.terms[place] == hashes[maybe]
            rows.append(row[maybe[hit]])
            found.append(self.order[place[hit]])
        pairs = np.unique(np.concatenate(rows) * (len(self.terms) + 1) + np.concatenate(found))
        return pairs // (len(self.terms) + 1), pairs % (len(self.terms) + 1)


@dataclass
class LabelModel:
    """A generative model of votes: rates of each voter per class, and weights against voters that repeat others."""

    prior: float
    rates: np.ndarray  # class x voter x (against, for)
    weights: np.ndarray
    correlations: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def calibrate(self, votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Stretch and shift the odds so that they fit known labels; the order of documents stays."""
        odds = self.odds(votes)
        (scale,), shift = _logistic((odds[:, None] / 4).astype(np.float32), y.astype(float), weight, 0.1)
        if scale > 0:
            self.scale, self.shift = scale / 4, shift

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) from a matrix of votes: 1 for, -1 against, 0 no vote (which tells something too)."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.odds(votes) + self.shift, -30, 30)))

    def odds(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(np.stack([self.rates[..., 0], 1 - self.rates.sum(axis=-1), self.rates[..., 1]], axis=-1))
        ratio = (log[1] - log[0]) * self.weights[:, None]
        return np.log(self.prior / (1 - self.prior)) + sum((votes == v) @ ratio[:, v + 1] for v in (-1, 0, 1))


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 25) -> LabelModel:
    """Expectation and maximisation over the votes; no labels.

    It begins with the majority of votes. Each round estimates the rates from the posterior, then the
    correlations of the voters' deviations from their class's rates; a voter counts as one over the sum of
    its correlations with all voters above ``CORRELATED``, itself included.
    """
    voters = votes.shape[1]
    half = np.full((2, voters, 2), 0.1)
    model = LabelModel(min(max(prior, 0.01), 0.99), half, np.ones(voters), np.eye(voters))
    p = np.clip(0.5 + 0.45 * np.sign(votes.sum(axis=1)), 0.05, 0.95)
    for _ in range(rounds):
        rates = np.empty((2, voters, 2))
        for y, weight in ((0, 1 - p), (1, p)):
            total = weight.sum()
            for k, vote in enumerate((-1, 1)):
                rates[y, :, k] = (weight @ (votes == vote) + 0.5) / (total + 2)
        model.rates = np.clip(rates, 1e-4, None) / np.maximum(1, rates.sum(axis=-1, keepdims=True) / 0.9998)
        mean = rates[:, :, 1] - rates[:, :, 0]
        off = votes - (p[:, None] * mean[1] + (1 - p)[:, None] * mean[0])
        scale = np.sqrt((off**2).mean(axis=0)) + 1e-6
        model.correlations = np.abs((off.T @ off) / len(votes) / np.outer(scale, scale))
        np.fill_diagonal(model.correlations, 1)
        model.weights = 1 / np.where(model.correlations > CORRELATED, model.correlations, 0).sum(axis=1)
        p = model.posterior(votes)
    return model


@dataclass
class Classifier:
    terms: np.ndarray  # hashes of the terms
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, bounds: np.ndarray, index: TermIndex) -> np.ndarray:
        row, term = index.present(data, bounds)
        sums = np.bincount(row, weights=self.weights[term], minlength=len(bounds) - 1)
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -30, 30)))


def _counts(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, and in how many texts of class 0 and of class 1 each stands."""
    found, counts = np.empty(0, np.uint64), np.empty((0, 2), np.int64)
    for low, _, data, bounds in list_blocks(texts):
        for hashes, row in term_hashes(data, bounds):
            if not len(hashes):
                continue
            order = np.lexsort((row, hashes))
            h, r = hashes[order], row[order]
            keep = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
            terms, which = np.unique(h[keep], return_inverse=True)
            both, places = np.unique(np.concatenate([found, terms]), return_inverse=True)
            sums = np.zeros((len(both), 2), np.int64)
            sums[places[: len(found)]] = counts
            for c in (0, 1):
                sums[places[len(found) :], c] += np.bincount(which[y[low + r[keep]] == c], minlength=len(terms))
            found, counts = both, sums
    return found, counts[:, 0], counts[:, 1]


def _false_finds(clean: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """How many terms in as many texts would stand in so many toxic ones if labels had no part in it, at most."""
    n = (clean + toxic).astype(np.int64)
    if not len(n):
        return np.empty(0)
    logs = np.concatenate([[0], np.cumsum(np.log(np.arange(1, n.max() + 1)))])  # of factorials
    toxic = toxic.astype(np.int64)
    chance = logs[n] - logs[toxic] - logs[n - toxic] + toxic * np.log(share)
    return np.bincount(n)[n] * np.exp(np.minimum(chance, 0))


def _matrix(texts: list[str], terms: np.ndarray) -> np.ndarray:
    index, out = TermIndex(terms), np.zeros((len(texts), len(terms)), np.float32)
    for low, _, data, bounds in list_blocks(texts):
        row, term = index.present(data, bounds)
        out[low + row, term] = 1
    return out


def _votes(lexicon: np.ndarray, texts: list[str]) -> np.ndarray:
    """Lexicon entries vote for; patterns over them and over the text vote both ways."""
    hits = lexicon.sum(axis=1)
    size = np.array([max(len(t), 1) for t in texts])
    shouting = np.array([sum(c.isupper() for c in t) / max(len(t), 1) for t in texts])
    patterns = [
        np.where(hits >= 1, 1, -1),
        np.where(hits >= 2, 1, np.where(hits == 0, -1, 0)),
        np.where(hits * 1000 > size, 1, np.where(hits == 0, -1, 0)),
        np.where((shouting > 0.3) & (hits > 0), 1, 0),
        np.where(hits >= 4, 1, 0),
    ]
    return np.concatenate([lexicon, np.stack(patterns, axis=1)], axis=1).astype(np.float32)


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 0.1, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a penalised logistic regression on soft targets, by Newton steps."""
    w, ridge = np.zeros(x.shape[1] + 1), np.full(x.shape[1] + 1, penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        slope, curvature = ridge * w, np.diag(ridge)
        for low in range(0, len(x), 512):  # a few rows at a time: the matrix itself is the largest thing held
            own = slice(low, low + 512)
            part = np.concatenate([x[own], np.ones((len(x[own]), 1), np.float32)], axis=1)
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            curve = (weight[own] * np.maximum(p * (1 - p), 1e-4)).astype(np.float32)
            curvature += (part * curve[:, None]).T @ part
            slope += part.T @ (weight[own] * (p - target[own]))
        step = np.linalg.solve(curvature, slope)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit(sample: list[tuple[str, int]], sizes: dict[int, int]) -> tuple[Classifier, LabelModel | None]:
    """The classifier and the label model from labelled texts and the class sizes they come from."""
    texts, y = [t for t, _ in sample], np.array([c for _, c in sample], np.int64)
    total = sum(sizes.values())
    prior = (sizes.get(1, 0) + 0.5) / (total + 1)
    known = np.array(sorted({int(_word_hash(w)) for w in LEXICON}), np.uint64)
    if len(set(y.tolist())) < 2:  # one class alone: the fixed lexicon decides
        return Classifier(known, np.full(len(known), 4.0), float(np.log(min(prior, 0.2) / (1 - min(prior, 0.2))))), None
    found, clean, toxic = _counts(texts, y)
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    # how much more often a term stands in toxic texts, less what chance alone gives
    odds = np.log((toxic + 0.2) / (n1 + 0.4)) - np.log((clean + 0.2) / (n0 + 0.4))
    sure = _false_finds(clean, toxic, n1 / len(y)) < FALSE_FINDS
    strength = np.where(sure, odds * np.sqrt(toxic), 0)
    # classes stand in the sample as in the table
    weight = np.where(y == 1, sizes.get(1, 0) / max(n1, 1), sizes.get(0, 0) / max(n0, 1))
    w0, w1 = weight[y == 0][0], weight[y == 1][0]
    strength[toxic * w1 < PURE * (toxic * w1 + clean * w0)] = 0
    # the mined voters: strong terms, each new to some toxic text so that they cover many
    best = np.argsort(-strength, kind="stable")[: 8 * MINED_VOTERS]
    best = best[strength[best] > 0]
    presence = _matrix([t for t, c in sample if c == 1], found[best]) if len(best) else np.zeros((n1, 0))
    covered, mined = np.zeros(n1), []
    for i, b in enumerate(best.tolist()):
        new = (presence[:, i] > 0) & (covered < 3)
        if new.any() and len(mined) < MINED_VOTERS:
            mined.append(b)
            covered += presence[:, i]
    entries = np.unique(np.concatenate([known, found[mined]])) if mined else known
    votes = _votes(_matrix(texts, entries), texts)
    model = fit_label_model(votes, float((y == 1).mean()))
    model.calibrate(votes, y, weight)
    posterior = model.posterior(votes)
    chosen = np.argsort(-strength, kind="stable")[:TERMS]
    terms = np.unique(np.concatenate([entries, found[chosen[strength[chosen] > 0]]]))
    w, bias = _logistic(_matrix(texts, terms), posterior, weight)
    return Classifier(terms, w.astype(np.float64), bias), model


def score(docs: DataFrame, model: Classifier, *more: str) -> DataFrame:
    """doc_id, text, the columns ``more`` as they are, and ``score`` between 0 and 1 of every whole text (null as empty)."""
    rows = documents(docs, *more)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TERMS numbers at most

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        index = TermIndex(own.terms)
        for batch in batches:
            scores = [own.score(data, bounds, index) for _, _, data, bounds in text_blocks(batch.column(1))]
            if scores:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(apply, StructType([*rows.schema.fields]).add("score", DoubleType()))


def train(docs: DataFrame, labels: DataFrame, train_rows: Column, limit: int = FIT_ROWS) -> Classifier:
    """The classifier of :func:`fit`. The driver keeps nothing of the sample, nor the memory that the fit took."""
    model, _ = fit(*labelled_sample(docs, labels, "toxic", train_rows, limit))
    give_back()
    return model


def learnable() -> Column:
    """Rows whose labels may be learned from."""
    return fold(3) != 1


def classify(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Labels of held-out rows, null labels, labels other than 0 and 1, and labels without a document are not
    used; of an id labelled twice the toxic label counts. Null and empty texts get the score of a text
    without terms. Without labels, or with one class alone, the fixed lexicon decides. Repeated rows are
    scored each; the same text has the same score. An empty table gives no rows.
    """
    scored = score(docs, train(docs, labels, learnable(), limit))
    return scored.select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
