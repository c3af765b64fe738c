"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled quality 1; everything else the model sees is unlabelled web text. A first
positive-against-unlabelled model gives the class prior as the least ratio, over upper score regions, of unlabelled
to positive mass. The final linear model over binned style features minimises
prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)) under logistic loss, so its output is a chance.

Defined results: null and empty texts are scored like any other; with no trusted positive every score is the prior
0.5; repeated rows each get a row. Columns other than doc_id and text are not read from documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, tokens

FOLDS, HELD_OUT = 4, 2
CUT = 0.7
#: Rows of either kind that the model is fitted on.
SAMPLE = 12000
BINS = 12
#: Parts of the sample that the prior is read off in turn.
PARTS = 5


def _styles(batches):
    for batch in batches:
        for texts in tokens.steps(batch.column("text")):
            x = features.style(texts)
            part = batch.slice(texts.first, len(texts))
            yield pa.RecordBatch.from_arrays([part.column("kind"), pa.array([r.tobytes() for r in x], pa.binary())], names=["kind", "x"])


class Binned:
    """One-hot quantile bins of each feature."""

    def __init__(self, x: np.ndarray):
        bins = int(np.clip(len(x) // 100, 3, BINS))  # few rows: wide bins
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        self.start = np.concatenate(([0], np.cumsum([len(c) + 1 for c in self.cuts])))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Column numbers, one per feature."""
        return np.stack([self.start[j] + np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1)


def _margin(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    return w[b].sum(1) + w[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int, rounds: int = 400, rate: float = 0.05) -> np.ndarray:
    """Adam steps from zero; the mean of the last quarter of them."""
    w, m, v, mean = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        if t > rounds * 3 // 4:
            mean += w / (rounds - rounds * 3 // 4)
    return mean


def _gather(b: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    g = np.bincount(b.ravel(), np.repeat(weight, b.shape[1]), size)
    g[-1] = weight.sum()
    return g


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.3) -> float:
    """The least ratio of unlabelled to positive mass over upper score regions that hold a share of positives."""
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 60))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    return float(np.clip((u / p).min(), 0.05, 0.99))


class Model:
    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, penalty: float = 1e-3):
        self.bins = Binned(np.concatenate([positive, unlabelled]))
        p, u, size = self.bins(positive), self.bins(unlabelled), int(self.bins.start[-1]) + 1
        keep = lambda w: penalty * np.append(w[:-1], 0)

        def against(w, p, u):
            return _gather(p, (_sigmoid(_margin(w, p)) - 1) / len(p), size) + _gather(u, _sigmoid(_margin(w, u)) / len(u), size) + keep(w)

        # the prior is read off scores of rows that the model behind them hasn't seen, all parts taken together
        sp, su = np.zeros(len(p)), np.zeros(len(u))
        for i in range(PARTS):
            a, b = np.arange(len(p)) % PARTS == i, np.arange(len(u)) % PARTS == i
            if a.all() or b.all():  # a single row of a kind
                continue
            first = _descend(lambda w, a=a, b=b: against(w, p[~a], u[~b]), size, 250)
            sp[a], su[b] = _margin(first, p[a]), _margin(first, u[b])
        self.prior = prior = estimate_prior(sp, su) if min(len(p), len(u)) > 1 else 0.5

        def risk(w):
            zp, zu = _margin(w, p), _margin(w, u)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            part = _gather(u, _sigmoid(zu) / len(u), size) - prior * _gather(p, _sigmoid(zp) / len(p), size)
            if negative < 0:  # the unbiased risk of negatives can't be below zero: step back instead
                return -part
            return prior * _gather(p, (_sigmoid(zp) - 1) / len(p), size) + part + keep(w)

        self.w = _descend(risk, size)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_margin(self.w, self.bins(x)))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from texts outside the held-out fold; of the labels only quality 1 is used."""
    key = F.col("doc_id")
    docs = documents.where(features.fold_key(key, FOLDS) != HELD_OUT).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trusted = labels.where((features.fold_key(key, FOLDS) != HELD_OUT) & (F.col("quality") == 1)).select("doc_id").distinct()
    n_docs, n_trusted = docs.count(), trusted.count()
    if not n_docs or not n_trusted:
        return None
    pick = lambda df, n, salt: df.where(features.unit(key, salt) < F.lit(min(1.0, sample / n)))
    positive = docs.join(F.broadcast(pick(trusted, n_trusted, "trusted")), "doc_id")  # at most about `sample` ids
    both = positive.select("text", F.lit(1).alias("kind")).unionByName(pick(docs, n_docs, "unlabelled").select("text", F.lit(0).alias("kind")))
    rows = both.mapInArrow(_styles, "kind int, x binary").toPandas()
    x, kind = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1), rows["kind"].to_numpy()
    return Model(x[kind == 1], x[kind == 0]) if (kind == 1).any() and (kind == 0).any() else None


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches):
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                part = batch.slice(texts.first, len(texts))
                score = model.score(features.style(texts)) if model else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(features.fold_key(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(documents, fit(documents, labels))
