"""Toxicity by weak supervision.

1. *Voters.*  A fixed lexicon of insults, a few patterns, and word forms and word
   beginnings that stand out in labelled toxic texts (a G-test against clean ones)
   each vote on a text or abstain.
2. *Label model.*  A generative model with the true label hidden gives each voter a
   rate of voting on toxic and on clean texts, by expectation maximisation.  The
   given labels are one more voter with an accuracy of its own.  Voters that are
   correlated beyond the label (a form and its beginning) share their weight: each is
   divided by the number of voters it stands for.
3. *Classifier.*  A logistic regression on votes learns the posterior labels.
4. Every whole text is scored in one narrow pass with the classifier's weights.

Fitting reads at most ``sample_rows`` labelled rows (a documented bound; chosen by a
hash of the id; equal texts count once, whatever their ids and partitions).  Labels of rows with ``crc32(doc_id) % 5 = 0`` are never read.  A score
depends on the text alone.

Defined results: null and empty texts score like a text without votes; without any
labels of both kinds only the fixed lexicon and patterns vote, with fixed weights, which
voters that no text of the sample moves have too;
equal texts have equal scores; labels that are null, repeated or contradict, of
one id or of equal texts, are left out, counted once, and taken as toxic.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, ship

#: Insults that need no context (fixed values).
INSULTS = ("idiot", "moron", "stupid", "scum", "loser", "trash", "clown", "pathetic", "worthless", "disgusting",
           "imbecile", "bastard", "bitch", "asshole", "retard", "filth", "vermin", "cretin", "dumbass", "degenerate")
BEGINNINGS = range(3, 8)
EDGE = b"\"'`.,;:!?()[]{}<>%&$#*@/\\|~^_=+-"
#: Least rate of the label 1 on toxic and greatest on clean texts.
LABEL = (0.85, 0.02)
#: Least ratio of a voter's rate on toxic to that on clean texts.
LIFT = 4
PATTERNS = ("pattern:shouting", "pattern:exclaiming")


def forms(text) -> list[bytes]:
    """Lower-case words without punctuation at their edges."""
    return [w.strip(EDGE) for w in as_bytes(text).lower().split()]


def traits(word: bytes) -> list[bytes]:
    """What a word can be voted on by: itself and its beginnings."""
    return [b"=" + word, *(b"^" + word[:k] for k in BEGINNINGS if len(word) > k)]


def patterns(text) -> list[int]:
    raw = as_bytes(text)
    letters = sum(map(len, raw.split())) or 1
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    found = []
    if upper > 20 and upper > 0.5 * letters:
        found.append(0)
    if raw.count(b"!!") >= 3:
        found.append(1)
    return found


class Voters(dict):
    """word -> numbers of the voters it moves; filled on demand, emptied at ``limit``."""

    def __init__(self, names: list[bytes], limit: int = 1 << 19):
        super().__init__()
        self.numbers = {n: i + len(PATTERNS) for i, n in enumerate(names)}
        self.count = len(names) + len(PATTERNS)
        self.limit = limit

    def __missing__(self, word: bytes):
        get = self.numbers.get
        found = tuple(n for n in map(get, traits(word)) if n is not None) or None
        self[word] = found
        return found

    def of(self, text) -> list[int]:
        if len(self) > self.limit:
            self.clear()
        votes = set(patterns(text))
        for n in filter(None, map(self.__getitem__, forms(text))):
            votes.update(n)
        return sorted(votes)


@dataclass
class Model:
    names: list[bytes]
    weights: np.ndarray
    bias: float

    def score(self, votes: list[int]) -> float:
        x = self.bias + float(self.weights[votes].sum())
        return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(text, y) of the distinct texts of at most ``rows`` labelled rows, none of them held out."""
    own = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .where("id is not null and y is not null").where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
           .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # bounded by ``rows``, so it may be broadcast: only their texts are shuffled
    return texts.join(F.broadcast(own), "id").groupBy("text").agg(F.max("y").alias("y"))


def _counts(batches):
    """Documents with each trait, by label, combined per partition."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    docs = [0, 0]
    for b in batches:
        for y, t in zip(b["y"], b["text"]):
            y = int(y > 0)
            docs[y] += 1
            counts[y].update({x for w in set(forms(t)) if w for x in traits(w)})
    names = set(counts[1]) | {b""}
    out = [(n, counts[1][n], counts[0][n]) if n else (b"", docs[1], docs[0]) for n in names]
    for s in range(0, len(out), 50_000):
        yield pd.DataFrame(out[s:s + 50_000], columns=["name", "toxic", "clean"])


def mine(rows: DataFrame, most: int, least: float) -> list[bytes]:
    """Traits that stand out in toxic texts, strongest first."""
    counts = (rows.mapInPandas(_counts, "name binary, toxic bigint, clean bigint")
              .groupBy("name").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    total = counts.where(F.length("name") == 0).first()
    if total is None or not total["a"] or not total["b"]:
        return []
    toxic, clean = total["a"], total["b"]
    p = toxic / (toxic + clean)
    n = F.col("a") + F.col("b")
    g = 2 * (F.col("a") * F.log(F.col("a") / (n * F.lit(p)))
             + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (n * F.lit(1 - p)))).otherwise(F.lit(0.0)))
    found = (counts.where((F.length("name") > 0) & (F.col("a") > 0)).withColumn("g", g)
             .where((F.col("g") >= least) & (F.col("a") * F.lit(clean) > LIFT * F.col("b") * F.lit(toxic)))
             .orderBy(F.desc("g"), "name").limit(most).collect())
    return [bytes(r["name"]) for r in found]


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior of a toxic text from votes (rows x voters, 0 or 1) and given labels."""
    v = np.c_[votes, given].astype(float)
    post = np.where(given > 0, 0.95, 0.05)
    for _ in range(rounds):
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        a = (post @ v + 0.5) / (post.sum() + 1)
        b = ((1 - post) @ v + 0.1) / ((1 - post).sum() + 1)
        # correlation given the label: voters that move together count as one
        r = v - post[:, None] * a - (1 - post)[:, None] * b
        s = np.sqrt((r ** 2).sum(axis=0)) + 1e-9
        corr = np.clip((r.T @ r) / s[:, None] / s[None, :], 0, 1)
        share = 1 / np.where(corr > 0.2, corr, 0).sum(axis=1).clip(1)
        # the label votes both ways and is right more often than not; a trait abstains
        a[-1], b[-1] = max(a[-1], LABEL[0]), min(b[-1], LABEL[1])
        on = np.log(a / b) * np.r_[share[:-1], 1.0]
        off = np.log((1 - a[-1]) / (1 - b[-1]))
        logit = np.log(prior / (1 - prior)) + v @ on + (1 - v[:, -1]) * off
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            return new
        post = new
    return post


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.1, rounds: int = 800) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels, by accelerated gradient steps of fixed size."""
    n, k = x.shape
    w, bias = np.zeros(k + 1), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    w[k] = bias
    z = np.c_[x, np.ones(n)]
    reg = np.r_[np.full(k, l2), 0.0]
    norm = np.ones(z.shape[1])
    for _ in range(12):
        norm = z.T @ (z @ norm)
        norm /= np.linalg.norm(norm)
    step = 1 / (0.25 * np.linalg.norm(z @ norm) ** 2 + l2)
    before = w
    for t in range(rounds):
        ahead = w + t / (t + 3) * (w - before)
        grad = z.T @ (1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30))) - y) + reg * ahead
        before, w = w, ahead - step * grad
    return w[:k], float(w[k])


def _collect_votes(names: list[bytes]):
    def run(batches):
        voters = Voters(names)
        for b in batches:
            yield pd.DataFrame({"y": b["y"].astype("int32"), "votes": [voters.of(t) for t in b["text"]]})
    return run


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = 10_000, most_voters: int = 400, least: float = 20.0) -> Model:
    """The classifier, fitted on a bounded sample."""
    ship(docs.sparkSession)
    rows = sample(docs, labels, id_col, text_col, label_col, sample_rows)
    fixed = [b"=" + w.encode() for w in INSULTS]
    mined = [n for n in mine(rows, most_voters, least) if n not in fixed]
    names = fixed + mined
    found = rows.mapInPandas(_collect_votes(names), "y int, votes array<int>").collect()
    votes = np.zeros((len(found), len(names) + len(PATTERNS)))
    for i, r in enumerate(found):
        votes[i, r["votes"]] = 1
    given = np.array([r["y"] > 0 for r in found], float)
    start = np.r_[np.full(len(PATTERNS), 0.5), np.full(len(names), 4.0)]
    if not 0 < given.sum() < len(given):
        return Model(names, start, -2.0)
    order = np.lexsort(np.c_[votes, given].T)  # the same sums whatever order rows came in
    votes, given = votes[order], given[order]
    post = label_model(votes, given)
    weights, bias = logistic(votes, post)
    weights = np.where(votes.any(axis=0), weights, start)
    return Model(names, weights, bias)


def _score(model: Model):
    def run(batches):
        voters = Voters(model.names)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": [model.score(voters.of(t)) for t in b["text"]]})
    return run


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per document row: doc_id, held_out, score and predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **kw)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return src.mapInPandas(_score(model), "doc_id bigint, score double").select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", **kw) -> DataFrame:
    """``docs``, all columns, without the texts that are predicted toxic."""
    model = fit(docs, labels, text_col=text_col, **kw)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        voters = Voters(model.names)
        return pd.Series([model.score(voters.of(t)) < 0.5 for t in texts], dtype=bool)

    return docs.where(clean(F.col(text_col)))
