"""Hierarchical language identification.

A text's byte trigrams and words, hashed, first pick a language family; within the family one-versus-one linear
support vector machines (squared hinge) vote. Fitting uses a sample of at most about SAMPLE rows per language.

Defined results: null texts and texts without a letter are `und` with score 0; where no language was learned every
text is `und`; a family of one language needs no second step; repeated rows each get a row; null lang is not
learned from. Columns other than doc_id, text and lang are not read, and lang only to learn.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, tokens

FOLDS = 5
DIM = 2048
#: Rows per language that the machines are fitted on.
SAMPLE = 800
# ISO 639 codes by family. A code outside the table is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk pl cs sk bg sr hr sl be mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tt",
    "indic": "hi bn ur pa mr gu ne",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def _profiles(batches):
    for batch in batches:
        for texts in tokens.steps(batch.column("text"), most=features.DENSE_ROWS):
            x = features.hashed_profile(texts, DIM)
            part = batch.slice(texts.first, len(texts))
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])


def svm(x: np.ndarray, sign: np.ndarray, penalty: float = 1e-4, rounds: int = 120) -> np.ndarray:
    """Weights and bias of a linear machine: squared hinge, equal weight for both sides, accelerated gradient steps."""
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, t, rate = w.copy(), 1.0, 1 / (2 * 2.0 + penalty)
    for _ in range(rounds):
        gap = np.maximum(0, 1 - sign * (x @ ahead[:-1] + ahead[-1])) * sign * weight * np.float32(-2)
        grad = np.append(x.T @ gap + penalty * ahead[:-1], gap.sum()).astype(np.float32)
        new, t_new = ahead - rate * grad, (1 + math.sqrt(1 + 4 * t * t)) / 2  # plain floats keep the arrays single
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


class Model:
    """Family machines, and the pair machines of each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        of = np.array(langs, object)
        groups: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            groups.setdefault(family(lang), []).append(lang)
        self.families = sorted(groups)
        self.members = [groups[f] for f in self.families]
        fam = np.array([family(v) for v in langs], object)
        self.top = self._pairs(x, fam, self.families)
        self.low = [self._pairs(x, of, m) for m in self.members]

    @staticmethod
    def _pairs(x, of, names):
        out = []
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                a, b = of == names[i], of == names[j]
                out.append((i, j, svm(x[a | b], np.where(a[a | b], 1.0, -1.0).astype(np.float32))))
        return out

    @staticmethod
    def _vote(x, machines, n):
        """The winner by votes, then by summed margins, and its mean chance against the others."""
        if n == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        score = np.zeros((len(x), n))
        for i, j, w in machines:
            p = 1 / (1 + np.exp(-4 * np.clip(x @ w[:-1] + w[-1], -20, 20)))
            score[:, i] += (p > 0.5) + p / n
            score[:, j] += (p <= 0.5) + (1 - p) / n
        best = score.argmax(1)
        chance = np.zeros(len(x))
        for i, j, w in machines:
            p = 1 / (1 + np.exp(-4 * np.clip(x @ w[:-1] + w[-1], -20, 20)))
            chance += np.where(best == i, p, 0) + np.where(best == j, 1 - p, 0)
        return best, chance / (n - 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top, chance = self._vote(x, self.top, len(self.families))
        lang = np.empty(len(x), object)
        for f, members in enumerate(self.members):
            if (rows := np.flatnonzero(top == f)).size:
                low, c = self._vote(x[rows], self.low[f], len(members))
                lang[rows] = np.array(members, object)[low]
                chance[rows] *= c
        return lang, np.clip(chance, 0, 1)


def fit(documents: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from rows outside the held-out fold that have a lang."""
    known = documents.where((features.fold_key(F.col("doc_id"), FOLDS) != 0) & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    rates = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count(F.lit(1))).alias("rate"))  # one row per language
    key = features.unit(F.col("doc_id"), "language")
    chosen = known.join(F.broadcast(rates), "lang").where(key < F.col("rate")).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    rows = chosen.mapInArrow(_profiles, "lang string, x binary").toPandas()
    if not len(rows):
        return None
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1)
    return Model(x, rows["lang"].tolist())


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""

    def run(batches):
        for batch in batches:
            for texts in tokens.steps(batch.column("text"), most=features.DENSE_ROWS):
                part = batch.slice(texts.first, len(texts))
                lang, score = model.predict(features.hashed_profile(texts, DIM)) if model else (np.full(len(texts), "und", object), np.zeros(len(texts)))
                none = ~part.column("letters").to_numpy(zero_copy_only=False)
                lang[none], score[none] = "und", 0.0
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(features.fold_key(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def report(documents: DataFrame) -> DataFrame:
    return predict(documents, fit(documents))
