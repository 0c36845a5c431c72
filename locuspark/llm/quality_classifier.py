"""Quality scores learned from positive and unlabelled texts.

A small network on figures of a text (shares of characters, repetition, line
shapes) minimises the non-negative risk of positive-unlabelled learning
(Kiryo et al., 2017): with prior p, positives P and unlabelled U,

    p * R_P(+) + max(0, R_U(-) - p * R_P(-)),

where a step that would push the second term below zero ascends it instead.

The prior is the share of positives in U, estimated from P and U alone by best bin estimation (Garg et al., 2021): of the texts that a
network which tells P from U ranks highest, nearly all are positive, so there the share of U above a bound, over that of P, tends to p.
Each half of the rows is ranked by a network that has seen the other half only, and the two estimates are averaged.
Labels other than 1 are never used.

Fitting uses at most ``max_positive`` labelled and ``max_unlabelled`` unlabelled
rows, those with the smallest hashes of their ids; only their figures (about 30 numbers a row) reach the driver. Figures
are of whole texts. Scoring is one pass without a shuffle.

Defined results: a null text is an empty one and is scored like any text; a very long one is read whole, in memory
in proportion to its length; a doc_id
that labels name more than once has its smallest label; rows that repeat a doc_id get a score each; a null
doc_id is not held out and has no label; without positives or unlabelled rows every score is 0.5;
an empty table gives an empty result; other columns of either table, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, with_text

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
HIDDEN = 24

_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!", b".,", b"?;:'\"()-", b" ", b"\n", bytes(range(128, 256))]
_CLASSES = np.array([[b in g for b in range(256)] for g in _GROUPS], np.float64)


def figures(text: bytes) -> np.ndarray:
    """The figures of one UTF-8 text; shares are between 0 and 1, sizes are logarithms."""
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    size = max(len(text), 1)
    words = text.split()
    n = max(len(words), 1)
    top = Counter(words).most_common(1)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(len(lines), 1)
    p = hist[hist > 0] / size
    return np.array(
        [
            *(_CLASSES @ hist / size),
            np.log1p(len(words)),
            np.log1p(len(text) / n),
            float(-(p * np.log(p)).sum()),
            triples / max(len(words) - 2, 1),
            sum(map(eq, words, words[1:])) / n,
            len(set(words)) / n**0.9,
            (top[0][1] if top else 0) / n,
            sum(map(bytes.isupper, words)) / n,
            text.count(b"!!") / n,
            hist[list(b"#*$%&|<>")].sum() / n,
            len(set(lines)) / m,
            np.log1p(n / m),
            sum(len(x) < 30 for x in lines) / m,
            sum(len(x) > 25 for x in words) / n,
            float(not words),
        ]
    )


def figure_rows(texts: pa.Array) -> np.ndarray:
    rows = [figures(x) for x in texts.cast(pa.large_binary()).to_pylist()]
    return np.stack(rows) if rows else np.empty((0, len(figures(b""))))


class Network:
    """One hidden layer, trained with Adam on the non-negative risk, or, without a prior, to tell the two samples apart."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int = HIDDEN, steps: int = 1500, seed: int = 7):
        rng = np.random.default_rng(seed)
        both = np.concatenate([positive, unlabelled])
        self.prior = prior
        self.mean, self.scale = both.mean(axis=0), both.std(axis=0) + 1e-6
        d = both.shape[1]
        self.weights = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in self.weights]
        p_rows, u_rows = self._scaled(positive), self._scaled(unlabelled)
        for step in range(1, steps + 1):
            p = p_rows[rng.integers(0, len(p_rows), 1024)]
            u = u_rows[rng.integers(0, len(u_rows), 2048)]
            _, _, grads = self.risk(p, u)
            rate = 0.01 * (1 - step / (steps + 1))
            for w, g, m in zip(self.weights, grads, moments, strict=True):
                g = g + 1e-4 * w
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                w -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)

    def risk(self, p: np.ndarray, u: np.ndarray) -> tuple[float, float, list[np.ndarray]]:
        """The two parts of the risk on scaled rows, and the gradient to descend.

        Losses are sigmoid, bounded so that single rows can't dominate: l(+) = s(-g), l(-) = s(g).
        """
        gp, hp = self._forward(p)
        gu, hu = self._forward(u)
        sp, su = _sigmoid(gp), _sigmoid(gu)
        slope_p, slope_u = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        if self.prior is None:
            first, second, d_p, d_u = (1 - sp).mean(), su.mean(), -slope_p, slope_u
        else:
            first, second = self.prior * (1 - sp).mean(), su.mean() - self.prior * sp.mean()
            # Below zero the second part alone is ascended.
            d_p, d_u = (-2 * self.prior * slope_p, slope_u) if second >= 0 else (self.prior * slope_p, -slope_u)
        return first, second, self._backward(p, hp, d_p, self._backward(u, hu, d_u, None))

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def _forward(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        h = np.tanh(rows @ a + b)
        return h @ c + d, h

    def _backward(self, rows: np.ndarray, h: np.ndarray, out: np.ndarray, more: list | None) -> list[np.ndarray]:
        inner = np.outer(out, self.weights[2]) * (1 - h * h)
        grads = [rows.T @ inner, inner.sum(axis=0), h.T @ out, np.array([out.sum()])]
        return [x + y for x, y in zip(grads, more, strict=True)] if more else grads

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self._forward(self._scaled(rows))[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_bin(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """The share of positives among the unlabelled, from scores of both: the ratio of their shares above the bound where its upper confidence limit is least."""
    bounds = np.unique(np.concatenate([positive, unlabelled]))
    above = lambda x: 1 - np.searchsorted(np.sort(x), bounds) / len(x)
    p, u = above(positive), above(unlabelled)
    slack = np.sqrt(np.log(4 / doubt) / (2 * len(unlabelled))) + np.sqrt(np.log(4 / doubt) / (2 * len(positive)))
    p, u = p[p > 0], u[p > 0]
    at = int(np.argmin((u + 1.01 * slack) / p))
    return float(u[at] / p[at])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, seed: int = 11) -> float:
    """The share of positives among the unlabelled rows of figures."""
    rng = np.random.default_rng(seed)
    half = [rng.permutation(len(x)) % 2 == 0 for x in (positive, unlabelled)]
    found = []
    for side in (True, False):
        learn = [x[h == side] for x, h in zip((positive, unlabelled), half, strict=True)]
        judge = [x[h != side] for x, h in zip((positive, unlabelled), half, strict=True)]
        if all(map(len, learn)) and all(map(len, judge)):
            network = Network(*learn, None, steps=steps, seed=seed)
            found.append(best_bin(*(network.score(x) for x in judge)))
    return min(max(float(np.mean(found)) if found else 0.5, 0.02), 0.98)


def held_out(doc: Column) -> Column:
    """The fold that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _sampled(docs: DataFrame, ids: DataFrame, most: int, id_col: str, text_col: str) -> np.ndarray:
    """Figures of the rows of the ``most`` ids (a column _id) with the smallest hashes; of rows that repeat an id the smallest text. At most that many ids are broadcast and as many rows of figures collected."""
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(quoted(id_col).alias("_id"), with_text(docs, text_col).alias("_text")).join(F.broadcast(chosen), "_id", "left_semi").groupBy("_id").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = figure_rows(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.list_(pa.float64()))], ["_id", "_f"])

    kind = dict(texts.dtypes)["_id"]
    found = texts.mapInArrow(run, f"_id {kind}, _f array<double>").toPandas().sort_values("_id")
    return np.stack(found["_f"].tolist()) if len(found) else np.empty((0, len(figures(b""))))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> tuple[Network | None, float]:
    """The network, or None if there is nothing to learn from, and the class prior."""
    known = labels.where(quoted(id_col).isNotNull() & quoted(label_col).isNotNull()).groupBy(quoted(id_col).alias("_id")).agg(F.min(quoted(label_col)).alias("_y"))
    training = known.where(~held_out(F.col("_id")))
    ids = docs.select(quoted(id_col).alias("_id")).where(F.col("_id").isNotNull() & ~held_out(F.col("_id"))).distinct()
    positive = _sampled(docs, training.where("_y = 1").select("_id"), max_positive, id_col, text_col)
    # Unlabelled texts; a label that is not learned from makes a text no less unlabelled, but its fold stays out whole.
    unlabelled = _sampled(docs, ids.join(known, "_id", "left_anti"), max_unlabelled, id_col, text_col)
    if not len(unlabelled):
        unlabelled = _sampled(docs, ids, max_unlabelled, id_col, text_col)
    if not len(positive) or not len(unlabelled):
        return None, 0.5
    prior = estimate_prior(positive, unlabelled)
    return Network(positive, unlabelled, prior), prior


def score(docs: DataFrame, network: Network | None, prior: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``held_out``, ``score`` and ``predicted`` for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                values = network.score(figure_rows(part.column(1))) if network else np.full(len(part), prior)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], ["_id", "score"])

    rows = docs.select(quoted(id_col).alias("_id"), with_text(docs, text_col).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    out = rows.mapInArrow(run, f"_id {kind}, score double")
    return out.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
