"""Quality classifier: weak labels, expectation-maximisation, a hashed linear scorer.

Two heads, ``junk`` and ``toxic``.  Heuristic labellers vote bad, good or abstain on
every document: shouting, symbol tails, bare separators, repeated neighbours, few
distinct words and dense punctuation for junk; an insult list, words and word
beginnings that labelled toxic documents favour, and their number for toxic; the
human label, where there is one, is one more voter in each head.

Expectation-maximisation on the counts of vote patterns of all documents (at most
3^7 patterns a head, whatever the input) estimates how each labeller votes on bad
and on good documents, and so the posterior of every pattern.  The posteriors of
a bounded, stratified sample of documents are the soft labels of a hashed linear
scorer over words, word beginnings and shape marks, which scores whole texts.
The share of distinct words is that of windows of ``NEAR`` words, averaged over all
words, so that it means the same at every length.

Bounds: ``LEXICON_ROWS`` labelled rows for the learned word lists, which take all their
words that are frequent and telling enough, and ``TRAIN_ROWS`` documents for the
scorer; vote patterns, and the scores, cover all documents.

Cases: null and empty texts have no votes but a label's and no features, so they
get the scorer's bias; without labelled rows the learned lists are empty;
contradicting labels of one document count as bad; repeated ids are scored row by
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain, read, small_batches, stored, uniform

LEXICON_ROWS, TRAIN_ROWS = 6000, 6000
BUCKETS = 1 << 18
CACHE_WORDS = 300_000
#: Distinct words are counted in consecutive windows of so many words.
NEAR = 400
BAD, GOOD, ABSTAIN = 2, 1, 0
JUNK, TOXIC = 6, 4  # labellers of a head, without the human label

# Common insults, the prior knowledge of one labeller.
INSULTS = frozenset("""
idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown
imbecile dumb jerk bastard filthy retard ugly hate
idiote salaud connard abruti imbécile crétin
dummkopf trottel arschloch abschaum
idiota imbécil estúpido basura
""".split())

_ENDS = re.compile(r"[!#$%&*@^~](?!\S)")
_MARK = re.compile(r"[^\w\s]")
_WORD = re.compile(r"[^\W\d_]+")


# --- labellers ------------------------------------------------------------------------

def _vote(x: float, bad: float, good: float) -> int:
    return BAD if x >= bad else GOOD if x <= good else ABSTAIN


def shape(text: str) -> tuple[int, list[float]]:
    """Number of words and the measures of the junk labellers."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, [0.0] * JUNK
    distinct = sum(len(set(words[i:i + NEAR])) for i in range(0, n, NEAR))
    odd = [w for w in words if not w[0].isalnum()]
    return n, [sum(map(str.isupper, words)) / n,
               len(_ENDS.findall(text)) / n,
               sum(not any(map(str.isalnum, w)) for w in odd) / n,
               sum(map(eq, words, words[1:])) / n,
               1 - distinct / n,
               len(_MARK.findall(text)) / max(1, len(text))]


def junk_votes(n: int, m: list[float]) -> list[int]:
    if n < 4:
        return [ABSTAIN] * JUNK
    return [_vote(m[0], 0.4, 0.15), _vote(m[1], 0.3, 0.1), _vote(m[2], 0.2, 0.05),
            _vote(m[3], 0.3, 0.05), _vote(m[4], 0.75, 0.6) if n >= 20 else ABSTAIN,
            _vote(m[5], 0.07, 0.045)]


def toxic_votes(words: set[str], lexicon: frozenset, starts: frozenset) -> list[int]:
    if not words:
        return [ABSTAIN] * TOXIC
    known = len(words & lexicon)
    begun = sum(w[:4] in starts or w[:5] in starts for w in words) if starts else 0
    return [BAD if words & INSULTS else ABSTAIN,
            (BAD if known else GOOD) if lexicon else ABSTAIN,
            (BAD if begun else GOOD) if starts else ABSTAIN,
            (BAD if known + begun > 2 else ABSTAIN if known + begun else GOOD)
            if lexicon or starts else ABSTAIN]


def learned_lists(documents: DataFrame, labels: DataFrame) -> tuple[frozenset, frozenset]:
    """Words, and word beginnings of four and five letters, that labelled toxic
    documents favour; from at most LEXICON_ROWS labelled rows, half of them toxic
    where there are enough."""
    told = labels.where("toxic IS NOT NULL")
    share = {r[0]: r[1] for r in told.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    if len(share) < 2:
        return frozenset(), frozenset()
    weight = F.when(F.col("toxic") > 0, F.lit(float(share[True]))).otherwise(F.lit(float(share[False])))
    order = uniform("doc_id", F.lit(5)) * weight
    sample = told.where(order <= 3 * LEXICON_ROWS).orderBy(order, "doc_id").limit(LEXICON_ROWS).select("doc_id", (F.col("toxic") > 0).cast("int").alias("t"))
    sample = stored(sample, "lexicon-sample")
    total = sample.agg(F.sum("t"), F.sum(1 - F.col("t"))).first()
    if not total[0] or not total[1]:
        return frozenset(), frozenset()
    words = documents.join(F.broadcast(sample), "doc_id").select("doc_id", "t", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))).alias("w"))
    words = stored(words, "lexicon-words")

    def favoured(key, least: int) -> frozenset:
        counted = words.select("doc_id", "t", key.alias("w")).where(F.length("w") >= least).distinct() \
            .groupBy("w").agg(F.sum("t").alias("a"), F.sum(1 - F.col("t")).alias("b"))
        odds = (F.col("a") / float(total[0])) / ((F.col("b") + 0.5) / float(total[1]))
        often = max(4.0, 0.015 * float(total[0]))  # a few copies of one text are no pattern
        rows = counted.where((F.col("a") >= often) & (odds >= 25))
        return frozenset(r[0] for r in rows.select("w").collect())

    w = F.col("w")
    starts = [favoured(F.when(F.length(w) > k, F.substring(w, 1, k)), k) for k in (4, 5)]
    return favoured(w, 3), starts[0] | starts[1]


def votes(documents: DataFrame, lexicon: frozenset, starts: frozenset) -> DataFrame:
    """``(doc_id, junk, toxic)``: the votes of each head as a string of digits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            junk, toxic = [], []
            for text in pdf["text"]:
                junk.append("".join(map(str, junk_votes(*shape(text)))))
                toxic.append("".join(map(str, toxic_votes(set(_WORD.findall(text.lower())), lexicon, starts))))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "junk": junk, "toxic": toxic})
    return documents.mapInPandas(run, "doc_id long, junk string, toxic string")


# --- expectation-maximisation ------------------------------------------------------------

def posteriors(patterns: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Probability of bad for every vote pattern, from the patterns' counts: a
    mixture of two classes in which labellers vote independently."""
    if not patterns:
        return {}
    keys = list(patterns)
    votes_ = np.array([[int(c) for c in k] for k in keys])
    count = np.array([patterns[k] for k in keys], float)
    bad, good = (votes_ == BAD).sum(1), (votes_ == GOOD).sum(1)
    q = np.where(bad >= 2, 0.95, np.where(bad == 1, 0.6, np.where(good > 0, 0.02, 0.1)))
    onehot = np.stack([votes_ == v for v in (GOOD, BAD)], 2).astype(float)  # abstaining says nothing
    for _ in range(rounds):
        logs = []
        for weight in (1 - q, q):
            w = weight * count
            p = np.einsum("p,pvk->vk", w, onehot) + 0.5
            p /= p.sum(1, keepdims=True)
            logs.append(np.einsum("pvk,vk->p", onehot, np.log(p)) + np.log((w.sum() + 1) / (count.sum() + 2)))
        q = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return dict(zip(keys, q.tolist()))


# --- the scorer ---------------------------------------------------------------------------

def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def _word_buckets(word: str) -> list[int]:
    return [_bucket("w" + word), _bucket("4" + word[:4]), _bucket("5" + word[:5])]


def _shape_marks(n: int, m: list[float]) -> list[str]:
    """Shape measures as features: each measure's level, as it is passed."""
    levels = (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.75)
    return [f"s{i}:{k}" for i, x in enumerate(m) for k, t in enumerate(levels) if x >= t] if n >= 4 else []


def buckets(text: str) -> np.ndarray:
    out = [b for w in set(_WORD.findall(text.lower())) for b in _word_buckets(w)]
    return np.array(out + [_bucket(f) for f in _shape_marks(*shape(text))], np.int32)


class Scorer:
    """Sum of the weights of a text's distinct words (with their beginnings) and
    shape marks, plus a bias, for each head."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    @functools.cached_property
    def _words(self):
        # both heads' weights as one complex number, so that one sum adds both
        both = (self.weights[0] + 1j * self.weights[1]).tolist()

        class Known(dict):
            def __missing__(self, word):
                a, b, c = _word_buckets(word)
                v = both[a] + both[b] + both[c]
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = v
                return v
        return Known(), both

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias}

    def scores(self, text: str) -> np.ndarray:
        known, both = self._words
        z = sum(map(known.__getitem__, set(_WORD.findall(text.lower()))), complex(*self.bias.tolist()))
        for f in _shape_marks(*shape(text)):
            z += both[_bucket(f)]
        return 1 / (1 + np.exp(-np.clip([z.real, z.imag], -50, 50)))


def fit(samples: list[np.ndarray], targets: np.ndarray, weight: np.ndarray, rounds: int = 150,
        decay: float = 3e-4, rare: int = 8) -> Scorer:
    """Logistic regression of both heads (rows of ``targets``) by full-batch Adam;
    features of fewer than ``rare`` samples keep weight 0."""
    often = np.bincount(np.concatenate([*samples, np.zeros(0, np.int32)]), minlength=BUCKETS) >= rare
    samples = [s[often[s]] for s in samples]
    sizes = np.array([len(s) for s in samples])
    index, at = np.concatenate([*samples, np.zeros(0, np.int32)]), np.repeat(np.arange(len(samples)), sizes)
    heads = targets.shape[0]
    w, b = np.zeros((heads, BUCKETS)), np.full(heads, -2.0)
    weight = weight / weight.sum()
    for h in range(heads):
        m, v, mb, vb = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
        for t in range(1, rounds + 1):
            z = np.bincount(at, w[h][index], len(samples)) + b[h]
            g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - targets[h]) * weight
            grad = np.bincount(index, g[at], BUCKETS) + decay * w[h]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            mb, vb = 0.9 * mb + 0.1 * g.sum(), 0.99 * vb + 0.01 * g.sum() ** 2
            w[h] -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-5)
            b[h] -= 0.1 * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-5)
    return Scorer(w.astype("f4"), b.astype("f4"))


def train(documents: DataFrame, labels: DataFrame) -> Scorer:
    """The scorer of ``documents(doc_id, text)`` and ``labels(doc_id, quality, toxic)``."""
    lexicon, starts = learned_lists(documents, labels)
    told = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")) \
        .withColumnRenamed("doc_id", "_id").select(
        "_id", F.when(F.col("quality") == 0, F.lit(str(BAD))).when(F.col("quality") > 0, F.lit(str(GOOD))).alias("lq"),
        F.when(F.col("toxic") > 0, F.lit(str(BAD))).when(F.col("toxic") == 0, F.lit(str(GOOD))).alias("lt"))
    cast = votes(documents, lexicon, starts)
    none = F.lit(str(ABSTAIN))
    cast = stored(cast.join(told, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", F.concat("junk", F.coalesce("lq", none)).alias("junk"),
        F.concat("toxic", F.coalesce("lt", none)).alias("toxic")), "votes")
    # at most 3^7 and 3^5 rows
    probability = {h: posteriors({r[0]: r[1] for r in cast.groupBy(h).count().collect()})
                   for h in ("junk", "toxic")}
    if not probability["junk"]:
        return Scorer(np.zeros((2, BUCKETS), "f4"), np.full(2, -5, "f4"))
    bad = lambda h: F.col(h).isin([k for k, p in probability[h].items() if p > 0.5])
    strata = cast.withColumn("s", F.when(bad("toxic"), F.lit(2)).when(bad("junk"), F.lit(1)).otherwise(F.lit(0)))
    sizes = {r[0]: r[1] for r in strata.groupBy("s").count().collect()}
    share = F.lit(0.0)
    for s, n in sizes.items():
        share = F.when(F.col("s") == s, F.lit(float(n))).otherwise(share)
    order = uniform("doc_id", F.lit(6)) * share
    picked = stored(strata.where(order <= 3 * TRAIN_ROWS).orderBy(order, "doc_id").limit(TRAIN_ROWS),
                    "train-sample")

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(f=[buckets(t).tobytes() for t in pdf["text"]]).drop(columns="text")

    rows = documents.join(F.broadcast(picked.dropDuplicates(["doc_id"])), "doc_id").select(
        "junk", "toxic", "s", "text").mapInPandas(
        featured, "junk string, toxic string, s int, f binary").collect()
    taken = np.bincount([r["s"] for r in rows], minlength=3)
    weight = np.array([sizes[r["s"]] / taken[r["s"]] for r in rows]) ** 0.5
    targets = np.array([[probability[h][r[h]] for r in rows] for h in ("junk", "toxic")])
    return fit([np.frombuffer(r["f"], np.int32) for r in rows], targets, weight)


def score(documents: DataFrame, scorer: Scorer, limit: float = 0.5) -> DataFrame:
    """``(doc_id, quality, toxicity, kept)`` of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = np.array([scorer.scores(t) for t in pdf["text"]], float).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": 1 - p[:, 0], "toxicity": p[:, 1],
                                "kept": (p < limit).all(1)})
    return documents.mapInPandas(run, "doc_id long, quality double, toxicity double, kept boolean")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    small_batches(documents.sparkSession)
    docs = plain(documents, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    told = plain(labels, doc_id="long", quality="int", toxic="int").where("doc_id IS NOT NULL")
    return score(docs, train(docs, told))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
