"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are counted in toxic and other labelled documents. Each token's score is the logarithm of
its smoothed frequency in toxic over that in other documents, where a Dirichlet prior, shaped like
the pooled counts, does the smoothing. Tokens count by a bound on false discoveries: however many are
tested and whatever the share of toxic labels, about ``FALSE`` of those with a score of their own have
it by chance. The others share one slightly negative score. One pass over a document finds all maximal segments of positive total.

Scores that are log-odds have the scale 1 of extreme-value theory: a segment of total S in n
tokens has the expectation n * exp(-S), and the probability 1 - exp(-n * exp(-S)). A document's
evidence is the sum of -ln of that over its significant segments; a logistic curve fitted to the
labelled documents turns evidence into a score between 0 and 1.

Nulls and empty texts have no evidence and get the score of documents without any. Without
labels, or with one class only, that score is the smoothed share of toxic labels. Repeated rows
are scored each for itself; an empty table gives no rows. Long texts are scored whole, in time in
proportion. Tokens of equal surprise are taken in order of their hash, segments of equal total
leftmost first. Columns other than doc_id and text are passed on by ``drop_toxic``, else not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, filter_slices, labelled, logistic_fit, map_slices, remainder, saved, with_labels
from .tokens import LOWER, WORDLIKE, Texts, run_hashes

PARTS, HELD = 4, 2
THRESHOLD = 0.3
#: Tokens in the model, at most, by weight of evidence.
MAX_TOKENS = 65_536
#: Weight of the Dirichlet prior, in tokens; least documents of a token to be tested; share of the
#: tokens with a score that may have it by chance.
PRIOR, MIN_DOCS, FALSE = 500.0, 5, 0.05
#: Steps of surprise for each unit, and the most, that the bound on false discoveries tells apart.
FINE, MOST = 10, 2000
#: A segment is significant up to this probability.
SIGNIFICANT = 0.5
MAX_EVIDENCE = 200.0


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # sorted token hashes
    scores: np.ndarray  # their log-odds
    other: float  # the score of every other token
    intercept: float
    slope: float

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + self.slope * evidence)))


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, start and end of each run of letters and digits, A-Z as a-z."""
    start, end = texts.runs(WORDLIKE[texts.data])
    return run_hashes(LOWER[texts.data], start, end), texts.doc_of(start), start, end


def maximal_segments(index: np.ndarray, score: np.ndarray, other: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, total) in order.

    ``index`` has the tokens with a score of their own; those between score ``other`` (below 0).
    Linear: every segment enters the list once and is merged away at most once.
    """
    found: list[list] = []  # first, last, total before it, total through it
    total, at = 0.0, 0
    for i, s in zip(index.tolist(), score.tolist()):
        total += (i - at) * other
        at = i + 1
        if s <= 0:
            total += s
            continue
        new = [i, i, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
        found.append(new)
    return [(a, b, right - left) for a, b, left, right in found]


def passages(texts: Texts, model: Model) -> list[list[tuple[int, int, float]]]:
    """For each text its significant passages: start byte, end byte, -ln of the probability."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(texts))]
    hashes, doc, start, end = tokens(texts)
    if not len(model.hashes) or not len(hashes):
        return out
    at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
    known = np.flatnonzero(model.hashes[at] == hashes)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    edges = np.searchsorted(known, first)
    for d in range(len(texts)):
        own = known[edges[d] : edges[d + 1]]
        n = int(first[d + 1] - first[d])
        for a, b, s in maximal_segments(own - first[d], model.scores[at[own]], model.other) if len(own) else ():
            # -ln(1 - exp(-E)) with E = n * exp(-s), which for small E is -ln(E)
            expected = n * np.exp(-s)
            surprise = -np.log(-np.expm1(-expected)) if expected > 1e-12 else s - np.log(n)
            if surprise >= -np.log(SIGNIFICANT):
                out[d].append((int(start[first[d] + a]), int(end[first[d] + b]), float(surprise)))
    return out


def _evidence(texts: Texts, model: Model) -> np.ndarray:
    total = np.array([sum(p[2] for p in found) for found in passages(texts, model)], float)
    return np.minimum(total, MAX_EVIDENCE)


def _surprise(k: Column, n: Column, share: float) -> Column:
    """-ln of the probability, at most (Chernoff, both sides), that k of n documents are toxic when
    this share of all is."""

    def term(a: Column, b: float) -> Column:
        return F.when(a > 0, a * F.log(a / b)).otherwise(0.0)

    return n * (term(k / n, share) + term(1 - k / n, 1 - share)) - float(np.log(2))


def least_surprise(steps: np.ndarray, counts: np.ndarray, common: np.ndarray) -> float:
    """The surprise from which tokens count (Benjamini and Hochberg), from how many tokens there are
    at each step of surprise, FINE to the unit; infinite if none do.

    Documents differ in topic, so tokens vary by more than chance. ``common`` counts the tokens that
    are frequent enough to show by how much: their median sets the unit of variance, at least 1.
    """
    if not counts.sum():
        return float("inf")
    order = np.argsort(-steps)
    steps, above, common = steps[order], np.cumsum(counts[order]), np.cumsum(common[order])
    square = 2 * (steps / FINE + np.log(2))
    spread = max(square[np.searchsorted(common, common[-1] / 2)] / 0.455, 1.0) if common[-1] else 1.0
    surprise = square / 2 / spread - np.log(2)
    good = np.flatnonzero(np.log(above[-1]) - surprise <= np.log(FALSE * above))
    return float(steps[good[-1]]) / FINE if len(good) else float("inf")


def train(docs: DataFrame, labels: DataFrame, max_training: int | None = None) -> Model:
    """The model of all labelled documents outside the held-out part, or of ``max_training``."""
    known = saved(labelled(labels, "toxic", PARTS, HELD, max_training), "toxic-labels")
    training = saved(with_labels(docs, known, PARTS, HELD), "toxic-training")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, toxic = Texts(batch.column(1)), batch.column(2).to_numpy()
        hashes, doc, _, _ = tokens(texts)
        order = np.lexsort((doc, hashes))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        word, which = np.unique(hashes, return_inverse=True)
        bad = toxic[doc] > 0
        counts = [np.bincount(which[m], minlength=len(word)) for m in (bad, ~bad, new & bad, new & ~bad)]
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), *(pa.array(c.astype(np.int64)) for c in counts)],
            names=["token", "toxic", "other", "toxic_docs", "other_docs"],
        )

    schema = "token long, toxic long, other long, toxic_docs long, other_docs long"
    sums = [F.sum(c).alias(c) for c in ("toxic", "other", "toxic_docs", "other_docs")]
    counted = saved(map_slices(training, count, schema).groupBy("token").agg(*sums), "toxic-counts")
    n_toxic, n_other = (v or 0 for v in counted.agg(F.sum("toxic"), F.sum("other")).first())
    share = training.agg(F.avg("label")).first()[0]
    model = Model(np.empty(0, np.uint64), np.empty(0), 0.0, 0.0, 0.0)
    if n_toxic and n_other:
        prior = PRIOR * (F.col("toxic") + F.col("other")) / (n_toxic + n_other)
        p, q = (F.col("toxic") + prior) / (n_toxic + PRIOR), (F.col("other") + prior) / (n_other + PRIOR)
        score = F.log(p / q)
        n_docs = F.col("toxic_docs") + F.col("other_docs")
        tested = counted.where(n_docs >= MIN_DOCS)
        common = (n_docs * min(share, 1 - share) >= MIN_DOCS).alias("common")
        tested = tested.select("token", common, score.alias("score"), _surprise(F.col("toxic_docs"), n_docs, share).alias("surprise"), p.alias("p"), q.alias("q"))
        step = F.least(F.floor(F.col("surprise") * FINE), F.lit(MOST * FINE)).alias("step")
        steps = tested.groupBy(step).agg(F.count("*").alias("all"), F.count_if("common").alias("common")).toPandas()
        least = least_surprise(*(steps[c].to_numpy(float) for c in ("step", "all", "common")))
        chosen = tested.where(F.col("surprise") >= least).orderBy(F.desc("surprise"), "token").limit(MAX_TOKENS)
        rows = chosen.toPandas()
        hashes = rows["token"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        rest = max(1 - rows["p"].sum(), 1e-9) / max(1 - rows["q"].sum(), 1e-9)
        other = min(float(np.log(rest)), -0.001)
        model = Model(hashes[order], rows["score"].to_numpy()[order], other, 0.0, 0.0)

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        evidence = np.round(_evidence(Texts(batch.column(1)), model), 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(evidence), batch.column(2).cast(pa.int64())], names=["evidence", "label"]
        )

    # at most 2,001 values of evidence and two labels
    curve = map_slices(training, weigh, "evidence double, label long")
    curve = curve.groupBy("evidence", "label").count().toPandas()
    x, y, n = (curve[c].to_numpy(float) for c in ("evidence", "label", "count"))
    if len(set(y)) < 2:
        share = ((n * y).sum() + 1) / (n.sum() + 2)
        return Model(model.hashes, model.scores, model.other, float(np.log(share / (1 - share))), 0.0)
    a, b = logistic_fit(x, y, n)
    return Model(model.hashes, model.scores, model.other, a, max(b, 0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and passages (byte spans) of every document."""

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = passages(Texts(batch.column(1)), model)
        evidence = np.minimum([sum(p[2] for p in f) for f in found], MAX_EVIDENCE)
        spans = [",".join(f"{a}:{b}" for a, b, _ in f) for f in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(model.probability(evidence)),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array(spans, pa.string()),
            ],
            names=["doc_id", "score", "n_passages", "passages"],
        )

    rows = map_slices(doc_columns(docs), compute, "doc_id long, score double, n_passages long, passages string")
    return rows.select(
        "doc_id",
        (remainder("doc_id", PARTS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
        "passages",
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold."""

    def keep(column: pa.Array) -> np.ndarray:
        return model.probability(_evidence(Texts(column), model)) < threshold

    return filter_slices(docs, keep)
