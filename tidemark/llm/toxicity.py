"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and word beginnings; the vocabulary keeps those that mark
toxic learning rows.  The model is fitted on a sample of the labels, bounded
by ``MAX_ROWS`` a class and drawn by a keyed hash, so it meets the documents
in a broadcast of bounded size and no text is shuffled; document frequencies
come from all documents.  Learning rows are the example set, searched exactly through a block-max inverted index: per term and block
of examples the largest weight is known, so a block's bound is a short
product, and blocks are visited from the best bound until the k-th neighbour
found beats the next bound.  Votes weigh by squared cosine against a constant
that stands for "nothing near"; learning rows kept out of the example set
calibrate the vote to a probability (pooled adjacent violators).

A score is a function of the text and the fitted model alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import checkpointed, map_rows, shipped

#: Learning rows of each class at most (the model is fitted on this sample of the labels), terms of the
#: vocabulary at most, and examples of each class at most: the bounds of the fitted model.
MAX_ROWS = 16_384
MAX_TERMS = 4096
MAX_EXAMPLES = 2048
#: A term is kept from so many toxic learning rows, times as frequent there, and likelihood ratio.
MIN_ROWS, MIN_LIFT, MIN_RATIO = 5, 3.0, 20.0
NEIGHBOURS = 15
#: Weight of "nothing near" in a vote.
NOTHING = 0.2
BLOCK = 64
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)


def terms_of(word: str) -> list[str]:
    """A word and its beginnings of 4 to 6 letters."""
    return [word, *(word[:n] + "*" for n in _STEMS if len(word) >= n)]


def in_fold(key: Column) -> Column:
    """Rows held out from learning: crc32 of the id as text leaves 1 when divided by 3 (null: not held out)."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def learning_rows(labels: DataFrame, id_col: str, label_col: str, max_rows: int = MAX_ROWS) -> tuple[DataFrame, dict]:
    """Sampled labels that may be learnt from, ``(lid, y)``, and how many labels of its class each stands for.

    Of several labels of a document the largest counts."""
    every = checkpointed(
        labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()
                     & ~in_fold(F.col(f"`{id_col}`")))
        .groupBy(F.col(f"`{id_col}`").alias("lid"))
        .agg((F.max(F.col(f"`{label_col}`").cast("int")) > 0).cast("int").alias("y")))
    total = {r.y: r["count"] for r in every.groupBy("y").count().collect()}  # two rows
    parts = [every.where(F.col("y") == y).orderBy(F.xxhash64("lid", F.lit("sample")), "lid").limit(max_rows)
             for y in (0, 1)]
    return checkpointed(parts[0].union(parts[1])), {y: max(1.0, n / max_rows) for y, n in total.items()}


def term_counts(texts: DataFrame, flush: int = 300_000) -> DataFrame:
    """``(term, pos, neg)``: rows of ``texts(y, body)`` that hold each term; term '' counts all rows."""

    def run(rows):
        pos: Counter = Counter()
        neg: Counter = Counter()
        for y, body in rows:
            found = {""}
            for w in set(_WORD.findall((body or "").lower())):
                found.update(terms_of(w))
            (pos if y else neg).update(found)
            if len(pos) + len(neg) > flush:
                yield from out(pos, neg)
                pos.clear()
                neg.clear()
        yield from out(pos, neg)

    def out(pos, neg):
        for t in pos.keys() | neg.keys():
            yield t, pos[t], neg[t]

    return (map_rows(texts, run, "term string, pos long, neg long")
            .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def select_terms(counts: DataFrame, max_terms: int = MAX_TERMS) -> list[str]:
    """Terms that mark toxic rows, by likelihood ratio."""
    counts = checkpointed(counts.where(f"pos >= {MIN_ROWS} or term = ''"))
    whole = counts.where("term = ''").first()
    if whole is None or not whole.pos or not whole.neg:
        return []
    p, n = float(whole.pos), float(whole.neg)
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    share = (a + b) / (p + n)
    ratio = 2 * (part(a, p * share) + part(b, n * share) + part(p - a, p * (1 - share)) + part(n - b, n * (1 - share)))
    kept = (counts.where("term != ''").withColumn("ratio", ratio)
            .where((F.col("ratio") >= MIN_RATIO) & ((a + 0.5) / (p + 1) > MIN_LIFT * (b + 0.5) / (n + 1))))
    return [r.term for r in kept.orderBy(F.desc("ratio"), "term").limit(max_terms).collect()]


class Terms:
    """Counts the vocabulary's terms of texts; one per task."""

    def __init__(self, vocabulary: list[str]):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.known: dict[str, tuple] = {}

    def counts(self, text: str | None) -> tuple[list[int], list[int]]:
        found: Counter = Counter()
        known, number = self.known, self.number
        for w, n in Counter(_WORD.findall((text or "").lower())).items():
            ids = known.get(w)
            if ids is None:
                if len(known) > 300_000:
                    known.clear()
                ids = known[w] = tuple(number[t] for t in terms_of(w) if t in number)
            for i in ids:
                found[i] += n
        at = sorted(found)
        return at, [found[i] for i in at]


@dataclass
class Model:
    """The fitted scorer: vocabulary, idf, examples in a block-max index, calibration."""
    vocabulary: list[str]
    idf: np.ndarray
    keys: list
    labels: np.ndarray
    rows: np.ndarray      # postings: example numbers, by term
    weights: np.ndarray   # postings: weights, by term
    offsets: np.ndarray   # first posting of each term and block
    bounds: np.ndarray    # largest weight of each term and block
    votes: np.ndarray | None = None   # calibration: votes and their probabilities
    chances: np.ndarray | None = None

    def weigh(self, ids, tf) -> tuple[np.ndarray, np.ndarray]:
        ids = np.asarray(ids, np.int64)
        w = (1 + np.log(np.asarray(tf, np.float64))) * self.idf[ids]
        return ids, w / np.sqrt(w @ w) if len(w) else w

    def nearest(self, ids: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of largest positive cosine, exactly; ties by example number."""
        if not len(ids) or not len(self.labels):
            return []
        bound = w @ self.bounds[ids]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-12:
                break
            score = np.zeros(BLOCK)
            lo, hi = self.offsets[ids, b].tolist(), self.offsets[ids, b + 1].tolist()
            for x, s, e in zip(w.tolist(), lo, hi):
                if s < e:
                    score[self.rows[s:e] - b * BLOCK] += x * self.weights[s:e]
            at = np.flatnonzero(score)
            best = sorted(best + [(-float(score[i]), b * BLOCK + i) for i in at.tolist()])[:k]
        return [(-s, i) for s, i in best]

    def vote(self, near: list[tuple[float, int]]) -> float:
        total = sum(s * s for s, _ in near)
        return sum(s * s for s, i in near if self.labels[i]) / (total + NOTHING)

    def chance(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.chances)) if self.votes is not None else vote

    def score(self, ids, tf) -> tuple[float, str]:
        """Calibrated score and the three nearest examples as ``id:cosine:label``."""
        near = self.nearest(*self.weigh(ids, tf))
        text = " ".join(f"{self.keys[i]}:{s:.4f}:{int(self.labels[i])}" for s, i in near[:3])
        return self.chance(self.vote(near)), text


def build_index(vocabulary: list[str], idf: np.ndarray, examples: list[tuple]) -> Model:
    """``examples``: (key, label, term numbers, counts).  Alike examples share blocks: the bounds are tighter."""
    examples = sorted(examples, key=lambda e: (e[1], list(e[2]), str(e[0])))
    blocks = max(1, -(-len(examples) // BLOCK))
    m = Model(vocabulary, idf, [e[0] for e in examples], np.array([e[1] for e in examples], np.int64),
              *[np.empty(0)] * 4)
    terms, rows, weights = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for i, e in enumerate(examples):
        t, w = m.weigh(e[2], e[3])
        terms.append(t)
        rows.append(np.full(len(t), i))
        weights.append(w)
    term, row, weight = map(np.concatenate, (terms, rows, weights))
    order = np.lexsort((row, term))
    term, m.rows, m.weights = term[order], row[order], weight[order]
    place = term * blocks + m.rows // BLOCK
    grid = np.arange(len(vocabulary) * blocks + 1)
    first = np.searchsorted(place, grid)
    m.offsets = np.stack([first[:-1].reshape(-1, blocks)[:, b] for b in range(blocks)]
                         + [first[blocks::blocks]], axis=1)
    top = np.zeros(len(vocabulary) * blocks)
    np.maximum.at(top, place, m.weights)
    m.bounds = top.reshape(-1, blocks)
    return m


def calibrate(model: Model, bins: list[tuple[int, float, float]], width: int) -> None:
    """Isotonic chances of votes from (bin, rows, toxic rows), each pool shrunk by two rows at the mean.

    Without rows, or with toxic ones only, nothing is known of clean texts: the vote stays the score."""
    bins = sorted(bins)
    n, pos = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not n or pos == n:
        return
    pools: list[list[float]] = []  # rows, toxic rows, first bin, last bin
    for at, rows, toxic in bins:
        pools.append([rows, toxic, at, at])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    votes, chances = [], []
    for rows, toxic, lo, hi in pools:
        for at in dict.fromkeys((lo, hi)):
            votes.append((at + 0.5) / width)
            chances.append((toxic + 2 * pos / n) / (rows + 2))
    model.votes, model.chances = np.array(votes), np.maximum.accumulate(chances)


def term_vectors(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """``(id, ids, tf)``: the vocabulary's terms of every whole text and their counts."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = shipped(docs.sparkSession, vocabulary)

    def run(rows: Iterator[tuple]):
        terms = Terms(sent())
        for key, body in rows:
            yield key, *terms.counts(body)

    return map_rows(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body")),
                    run, f"id {kind}, ids array<int>, tf array<int>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS,
        max_examples: int = MAX_EXAMPLES) -> tuple[Model, DataFrame]:
    """(model, term vectors of all documents).  Rows held out by ``in_fold`` are never learnt from."""
    sample, weight = learning_rows(labels, id_col, label_col, max_rows)
    learn = F.broadcast(sample)  # 2 * max_rows rows of two numbers at most
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
    seen = texts.where(~in_fold(F.col("id"))).join(learn, F.col("id") == F.col("lid")).select("y", "body")
    vocabulary = select_terms(term_counts(seen), max_terms)
    vectors = checkpointed(term_vectors(docs, vocabulary, id_col, text_col))
    held = vectors.select(F.explode("ids").alias("t")).groupBy("t").count().collect()  # a row per term
    df = np.zeros(len(vocabulary))
    for r in held:
        df[r["t"]] = r["count"]
    idf = np.log((vectors.count() + 1) / (df + 1)) + 1
    mark = F.xxhash64("id", F.lit("examples"))
    known = vectors.join(learn, F.col("id") == F.col("lid")).withColumn("mark", mark)
    pool = known.where((F.pmod("mark", F.lit(3)) != 0) & (F.size("ids") > 0))
    examples = [(r.id, r.y, r.ids, r.tf) for y in (0, 1) for r in
                pool.where(F.col("y") == y).orderBy("mark", "id", "ids", "tf").limit(max_examples).collect()]
    model = build_index(vocabulary, idf, examples)
    width = 1000
    sent = shipped(docs.sparkSession, model)

    def run(rows):
        m = sent()
        for y, ids, tf in rows:
            yield min(width - 1, int(m.vote(m.nearest(*m.weigh(ids, tf))) * width)), y

    votes = map_rows(known.where(F.pmod("mark", F.lit(3)) == 0).select("y", "ids", "tf"), run, "bin int, y int")
    bins: dict[int, list[float]] = {}
    for r in votes.groupBy("bin", "y").count().collect():  # two rows per bin
        rows = r["count"] * weight[r.y]
        now = bins.setdefault(r.bin, [0.0, 0.0])
        now[0] += rows
        now[1] += rows * r.y
    calibrate(model, [(b, n, pos) for b, (n, pos) in bins.items()], width)
    return model, vectors


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` for every row.

    ``evidence``: the three nearest examples as ``id:cosine:label``.  Null and
    empty texts, and texts without a term of the vocabulary, have no
    neighbours and the calibrated chance of such rows; without labels of both
    classes every score is 0.  Null ids are scored and never learnt from;
    repeated rows are returned as often as they came; null labels are
    ignored; extra columns too.  An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    model, vectors = fit(docs, labels, id_col, text_col, label_col)
    sent = shipped(docs.sparkSession, model)

    def run(rows):
        m, known = sent(), {}
        for key, ids, tf in rows:
            vector = (tuple(ids), tuple(tf))
            if vector not in known:
                if len(known) > 50_000:
                    known.clear()
                known[vector] = m.score(ids, tf)
            yield key, *known[vector]

    scored = map_rows(vectors, run, f"id {kind}, score double, evidence string")
    return scored.select(F.col("id").alias(id_col), in_fold(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Rows of ``docs`` scored below ``threshold``; all columns are kept, whatever their names.

    Decided by text alone: equal texts share their fate, ids may be null or
    repeated.  Null and empty texts have no neighbours and the chance of such
    rows; without labels of both classes every row stays; an empty table gives
    an empty result.
    """
    model, _ = fit(docs, labels, id_col, text_col, label_col)
    sent = shipped(docs.sparkSession, model)

    @pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        m = sent()
        terms = Terms(m.vocabulary)
        return pd.Series([m.score(*terms.counts(t))[0] for t in text], dtype="float64")

    return docs.where(score(F.col(f"`{text_col}`").cast("string")) < threshold)
