"""Toxicity by weak supervision.

Lexicon and pattern voters mark every text 1 (toxic), 0 (not) or abstain. Besides fixed lists, two lexicons are
induced from labelled rows outside the held-out fold: words, and word beginnings (for inflected languages), that
occur in toxic rows almost only. Only the counts of the distinct vote
patterns reach the driver (at most 3**voters, in practice some dozens). A generative label model over them,
fitted by expectation maximisation, gives each voter its accuracy and ties voters that depend on one another given
the label into a tree (largest conditional mutual information), so that correlated voters aren't counted twice. Its
posterior (labels of the learning rows count where there are any) marks a bounded sample, on which a sparse linear classifier over hashed words and word beginnings is
trained; that classifier scores every whole text. Without labels the fixed voters remain.

Defined results: null and empty texts get the classifier's score of no words; without rows to learn from scores
are 0; repeated rows each get a row. Columns other than doc_id and text are not read from documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, tokens

FOLDS = 5
#: Rows on posterior labels that the classifier is trained on.
SAMPLE = 12000
#: Labelled rows that lexicons are induced from.
LABELLED = 6000
#: Toxic rows that an induced entry needs, and the clean rows it may have for each of them.
LEAST, IMPURE = 6, 0.05
#: Columns of the classifier that may have a weight.
COLUMNS = 1500
BITS = 18
ABSTAIN = -1

# Common insults and profanity by kind. Extend per language as needed.
LEXICONS = {
    "intellect": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile dimwit halfwit cretin dunce brainless",
    "worth": "worthless pathetic loser losers wretch lowlife deadbeat pitiful",
    "disgust": "scum trash disgusting filth filthy vermin repulsive scumbag",
    "mockery": "clown clowns laughable weirdo buffoon jackass",
    "profanity": "fuck fucking fucker shit shitty bullshit bitch bastard asshole whore slut cunt",
    "german": "idioten dummkopf trottel arschloch scheisse scheiße wichser abschaum blödmann mistkerl hurensohn",
    "french": "imbécile crétin connard connasse salaud salope putain abruti",
    "spanish": "idiota imbécil estúpido estúpida pendejo cabrón asqueroso gilipollas",
}
# Patterns of hostile address and of disguised insults.
PATTERNS = {
    "address": r"\b(?:you are|you're|ur) (?:an? |such an? |the )?(?:idiot|moron|loser|clown|stupid|pathetic|worthless|trash|scum|disgusting|dumb|fool|joke)|\bshut up\b|\bgo to hell\b|\bgo die\b",
    "disguise": r"\b(?:[i1!]d[i1!][o0]t|m[o0]r[o0]n|st[u*]p[i1!]d|l[o0@]s[e3]r|f[*u]+ck|sh[i1*!]+t|b[i1*!]tch|a[s$]{2}h[o0]le)s?\b",
}


def _hash_of(words: str) -> np.ndarray:
    raw = " ".join(words.split()).encode()
    return np.unique(tokens.words(tokens.Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), 0)).hash)


VOTERS = (*LEXICONS, *PATTERNS, "induced_words", "induced_stems", "density", "shouting", "clean")


class Voters:
    """Votes of all voters on texts: an int8 array with a column per voter."""

    def __init__(self, words: np.ndarray, stems: np.ndarray):
        self.lists = [_hash_of(v) for v in LEXICONS.values()]
        self.patterns = [re.compile(v.encode(), re.IGNORECASE) for v in PATTERNS.values()]
        self.words, self.stems = words, stems

    def __call__(self, texts: tokens.Texts, w: tokens.Words) -> np.ndarray:
        n, m = len(texts), len(self.lists)
        hits = np.stack([np.bincount(w.text[np.isin(w.hash, own)], minlength=n) for own in self.lists], axis=1)
        votes = np.full((n, len(VOTERS)), ABSTAIN, np.int8)
        votes[:, :m][hits > 0] = 1
        base, ends = texts.data.tobytes(), texts.offsets[1:]
        for j, pattern in enumerate(self.patterns):
            for found in pattern.finditer(base):
                i = int(np.searchsorted(ends, found.start(), "right"))
                if found.end() <= ends[i]:
                    votes[i, m + j] = 1
        m += len(self.patterns)
        stem_text, stem = features.stem_hashes(w)
        votes[w.text[np.isin(w.hash, self.words)], m] = 1
        votes[stem_text[np.isin(stem, self.stems)], m + 1] = 1
        insults, any_vote = hits.sum(1), (votes == 1).any(1)
        votes[:, -3] = np.where((insults >= 2) & (insults * 200 >= np.diff(w.first)), 1, ABSTAIN)
        upper = np.bincount(np.repeat(np.arange(n), np.diff(texts.offsets))[(texts.data >= 65) & (texts.data <= 90)], minlength=n)
        votes[:, -2] = np.where((upper * 2 > np.diff(texts.offsets)) & any_vote, 1, ABSTAIN)
        votes[:, -1] = np.where(any_vote, ABSTAIN, 0)
        return votes


def _labelled(batches):
    """Per row the distinct 64-bit hashes of words and of stems."""
    for batch in batches:
        for texts in tokens.steps(batch.column("text")):
            w = tokens.words(texts)
            stem_text, stem = features.stem_hashes(w)
            rows = {"words": [], "stems": []}
            for name, of, value in (("words", w.text, w.hash), ("stems", stem_text, stem)):
                order = np.lexsort((value, of))
                of, value = of[order], value[order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
                of, value = of[new], value[new]
                cut = np.searchsorted(of, np.arange(len(texts) + 1))
                rows[name] = [value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            part = batch.slice(texts.first, len(texts))
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows["words"], pa.binary()), pa.array(rows["stems"], pa.binary())], names=["toxic", "words", "stems"])


def induce(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the stems that labelled toxic rows have and clean ones lack. Copies count once."""
    none = np.zeros(0, np.uint64)
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if not n:
        return none, none
    chosen = known.where(features.unit(F.col("doc_id"), "labelled") < F.lit(min(1.0, sample / n)))  # at most about `sample` ids
    rows = docs.join(F.broadcast(chosen), "doc_id").select("toxic", "text").mapInArrow(_labelled, "toxic int, words binary, stems binary").toPandas()
    rows = rows.drop_duplicates("words")
    out = []
    for name in ("words", "stems"):
        count = {}
        for label in (1, 0):
            raw = b"".join(rows.loc[rows["toxic"] == label, name])
            count[label] = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
        value, toxic = count[1]
        at = np.searchsorted(count[0][0], value)
        near = np.minimum(at, max(len(count[0][0]) - 1, 0))
        clean = np.where(count[0][0][near] == value, count[0][1][near], 0) if len(count[0][0]) else np.zeros(len(value))
        out.append(value[(toxic >= LEAST) & (clean <= IMPURE * toxic)])
    return out[0], out[1]


class LabelModel:
    """P(votes, label): a vote depends on the label and, where that matters, on one other voter.

    counts are of rows with each pattern of votes; known holds, for those of them that carry a label, the numbers of
    toxic and clean ones, whose labels stand in for the posterior."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, balance: float = 0.1, known: tuple[np.ndarray, np.ndarray] | None = None, rounds: int = 30, link: float = 0.002):
        v = patterns.astype(int) + 1
        m = v.shape[1]
        toxic, clean = known or (np.zeros(len(v)), np.zeros(len(v)))
        # voters that vote alike share one vote in the first guess (more votes for toxic than against), and one factor
        # until the labels are clear enough to tell dependence from accuracy
        signed = np.where(v == 2, 1.0, np.where(v == 1, -1.0, 0.0))
        centred = signed - (signed * counts[:, None]).sum(0) / counts.sum()
        spread = np.sqrt((centred**2 * counts[:, None]).sum(0)) + 1e-12
        alike = np.abs((centred * counts[:, None]).T @ centred / spread[:, None] / spread[None, :]) ** 4
        self.weight = 1 / np.maximum(alike.sum(1), 1.0)
        post = np.where(signed @ self.weight > 0, 0.9, 0.1 * balance)
        if not (toxic.sum() and clean.sum()):  # without labels of both kinds a fifth of the rows is held at the first guess
            toxic, clean = counts * post / 5, counts * (1 - post) / 5
        post = (toxic + post) / (toxic + clean + 1)
        self.balance, self.parent = balance, [None] * m
        for at in range(rounds):
            if at == rounds // 2:
                self.parent, self.weight = self._tree(v, counts, post, link), np.ones(m)
            # labels count as they are, the other rows by the posterior
            mixed = (toxic + np.maximum(counts - toxic - clean, 0) * post) / np.maximum(counts, 1e-9)
            self._tables(v, counts, mixed)
            post = self.posterior(patterns)
        #: Chance that a vote of each voter is right, where it votes.
        self.accuracy = [
            float((counts * np.where(v[:, j] == 2, post, 1 - post))[v[:, j] > 0].sum() / max(counts[v[:, j] > 0].sum(), 1e-9)) for j in range(m)
        ]

    def _tables(self, v, counts, post):
        self.prior = float(np.clip((counts * post).sum() / counts.sum(), 1e-4, 0.9))
        self.tables = []
        for j, p in enumerate(self.parent):
            t = np.full((2, 3, 3), 0.05)  # label, parent's vote (0 without parent), own vote
            of = v[:, p] if p is not None else np.zeros(len(v), int)
            np.add.at(t[1], (of, v[:, j]), counts * post)
            np.add.at(t[0], (of, v[:, j]), counts * (1 - post))
            self.tables.append(t / t.sum(2, keepdims=True))

    @staticmethod
    def _tree(v, counts, post, link):
        """The strongest dependences given the label, as a forest (each voter has at most one parent)."""
        m, total = v.shape[1], counts.sum()
        edges = []
        for i in range(m):
            for j in range(i + 1, m):
                info = 0.0
                for weight in (counts * post, counts * (1 - post)):
                    joint = np.zeros((3, 3))
                    np.add.at(joint, (v[:, i], v[:, j]), weight)
                    joint /= max(joint.sum(), 1e-9)
                    free = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
                    seen = joint > 0
                    info += weight.sum() / total * (joint[seen] * np.log(joint[seen] / free[seen])).sum()
                if info > link:
                    edges.append((info, i, j))
        near: dict[int, list[int]] = {i: [] for i in range(m)}
        group = list(range(m))
        for _, i, j in sorted(edges, reverse=True):
            if group[i] != group[j]:
                group = [group[i] if g == group[j] else g for g in group]
                near[i].append(j)
                near[j].append(i)
        parent, seen = [None] * m, set()
        for root in range(m):
            todo = [root] if root not in seen else []
            seen.add(root)
            while todo:
                i = todo.pop()
                for j in near[i]:
                    if j not in seen:
                        seen.add(j)
                        parent[j] = i
                        todo.append(j)
        return parent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = patterns.astype(int) + 1
        log = np.zeros((len(v), 2)) + np.log([1 - getattr(self, "prior", self.balance), getattr(self, "prior", self.balance)])
        for j, p in enumerate(self.parent):
            of = v[:, p] if p is not None else np.zeros(len(v), int)
            for y in (0, 1):
                log[:, y] += self.weight[j] * np.log(self.tables[j][y][of, v[:, j]])
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))


def _key(votes: np.ndarray) -> list[str]:
    marks = np.array(["0", "1", "-"])
    return ["".join(row) for row in marks[votes]]


def _unkey(keys: list[str]) -> np.ndarray:
    return np.array([[{"0": 0, "1": 1, "-": -1}[c] for c in k] for k in keys], np.int8).reshape(len(keys), len(VOTERS))


def _vote(words: np.ndarray, stems: np.ndarray):
    def run(batches):
        vote = Voters(words, stems)
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_key(vote(texts, tokens.words(texts))), pa.string())], names=["doc_id", "votes"])

    return run


def _vote_and_words(words: np.ndarray, stems: np.ndarray):
    def run(batches):
        vote = Voters(words, stems)
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                w = tokens.words(texts)
                at, column = features.present(w, BITS)
                cut = np.searchsorted(at, np.arange(len(texts) + 1))
                column = column.astype(np.int32)
                rows = [column[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_key(vote(texts, w)), pa.string()), pa.array(rows, pa.binary())], names=["votes", "words"])

    return run


def train_linear(rows: list[np.ndarray], target: np.ndarray, columns: int = COLUMNS, rounds: int = 200, penalty: float = 1e-5) -> np.ndarray:
    """Weights and bias of logistic regression on soft labels.

    Only the columns that go with the label most clearly (largest standard score, at least 4) get a weight."""
    column = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    mean = float(np.clip(target.mean(), 1e-4, 1 - 1e-4)) if len(target) else 1e-4
    n = np.bincount(column, minlength=1 << BITS)
    z = (np.bincount(column, target[owner], 1 << BITS) - n * mean) / np.sqrt(n * mean * (1 - mean) + 1e-9)
    chosen = np.argsort(-np.abs(z), kind="stable")[:columns]
    chosen = chosen[(np.abs(z[chosen]) >= 4) & (n[chosen] >= min(3, 1 + len(rows) // 100))]
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    at = place[column]
    owner, at = owner[at >= 0], at[at >= 0]
    size = len(chosen)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(mean / (1 - mean))
    for t in range(1, rounds + 1):
        gap = 1 / (1 + np.exp(-np.clip(w[-1] + np.bincount(owner, w[at], len(rows)), -30, 30))) - target
        g = np.append(np.bincount(at, gap[owner], size), gap.sum()) / max(len(rows), 1) + penalty * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    out = np.zeros((1 << BITS) + 1)
    out[chosen], out[-1] = w[:-1], w[-1]
    return out


def fit(documents: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> tuple[np.ndarray, LabelModel | None]:
    """Weights of the classifier and the label model, from rows outside the held-out fold."""
    key = F.col("doc_id")
    docs = documents.where(features.fold_key(key, FOLDS) != 0).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = labels.where(features.fold_key(key, FOLDS) != 0) if labels is not None else None
    lexicons = induce(docs, own) if own is not None else (np.zeros(0, np.uint64),) * 2
    voted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_vote(*lexicons), "doc_id long, votes string")
    if own is not None:
        known = own.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
        voted = voted.join(known, F.col("doc_id") == F.col("id"), "left")
    else:
        voted = voted.withColumn("toxic", F.lit(None).cast("int"))
    # one row per pattern of votes
    counts = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).toPandas()
    none = np.zeros((1 << BITS) + 1)
    none[-1] = -30
    if not len(counts):
        return none, None
    model = LabelModel(_unkey(counts["votes"].tolist()), counts["count"].to_numpy(float), known=(counts["toxic"].to_numpy(float), counts["clean"].to_numpy(float)))
    rate = min(1.0, sample / counts["count"].sum())
    rows = docs.where(features.unit(key, "toxicity") < F.lit(rate)).select("text").mapInArrow(_vote_and_words(*lexicons), "votes string, words binary").toPandas()
    if not len(rows):
        return none, model
    names = sorted(set(rows["votes"]))
    chance = dict(zip(names, model.posterior(_unkey(names)), strict=True))
    return train_linear([np.frombuffer(r, np.int32) for r in rows["words"]], rows["votes"].map(chance).to_numpy()), model


def predict(documents: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    small = weights.astype(np.float32)

    def run(batches):
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                part = batch.slice(texts.first, len(texts))
                at, column = features.present(tokens.words(texts), BITS)
                score = 1 / (1 + np.exp(-np.clip(small[-1] + np.bincount(at, small[column], len(texts)), -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(features.fold_key(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def report(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    return predict(documents, fit(documents, labels)[0])


def drop_toxic(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of documents that the classifier doesn't reject; all columns stay."""
    weights = fit(documents, labels)[0].astype(np.float32)
    names = documents.columns
    schema = documents.schema

    def run(batches):
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                at, column = features.present(tokens.words(texts), BITS)
                margin = weights[-1] + np.bincount(at, weights[column], len(texts))
                yield batch.slice(texts.first, len(texts)).filter(pa.array(margin < 0))

    return documents.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)
