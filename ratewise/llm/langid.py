"""Language identification by a byte convolutional network in numpy.

Lower-cased UTF-8 bytes are embedded, filters of several widths run over
fixed-length windows, each filter's largest answer in the window is kept (max
pooling), and a softmax layer gives the language.  All windows of every whole
text are scored in batches; a text's probabilities are the mean over its
windows.

The model is fitted on the driver with a bounded sample of labelled rows: one
window of about ``PER_LANGUAGE`` documents at most of every language (a hash of the
document id decides, so the sample is the same on every run).  Prediction reads the text alone.

Cases: a null text, or one without a letter, gives ``und`` with score 0; with no
labelled row every text does; repeated ids and texts are predicted each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let_go, plain, read, small_batches, uniform

#: Bound of the training sample.
PER_LANGUAGE = 1200
#: Bytes of a window; windows scored at once.
WINDOW, BATCH = 128, 512
UNKNOWN = "und"


def windows(text: str) -> np.ndarray:
    """All windows of a text as rows of bytes: back to back, the last one ending
    with the text; a short text is padded with zeros."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    if len(b) <= WINDOW:
        out = np.zeros((1, WINDOW), np.uint8)
        out[0, :len(b)] = b
        return out
    n = len(b) // WINDOW
    out = b[:n * WINDOW].reshape(n, WINDOW)
    return out if n * WINDOW == len(b) else np.concatenate((out, b[-WINDOW:].reshape(1, WINDOW)))


@dataclass
class ByteNet:
    """Filters of all widths share one matrix over the widest field; narrower
    ones keep zeros beyond their width."""

    languages: list[str]
    size: int = 8
    filters: dict[int, int] = field(default_factory=lambda: {2: 8, 3: 12, 4: 12})
    seed: int = 7

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.widest, n = max(self.filters), sum(self.filters.values())
        self.embed = rng.normal(0, 0.5, (256, self.size)).astype("f4")
        self.embed[0] = 0
        self.mask = np.zeros((self.widest * self.size, n), "f4")
        at = 0
        for width, k in self.filters.items():
            self.mask[:width * self.size, at:at + k] = 1
            at += k
        self.kernel = (rng.normal(0, 0.3, self.mask.shape) * self.mask).astype("f4")
        self.bias = np.zeros(n, "f4")
        self.out = rng.normal(0, 0.3, (n, len(self.languages))).astype("f4")
        self.out_bias = np.zeros(len(self.languages), "f4")

    def _fields(self, x: np.ndarray) -> np.ndarray:
        e = self.embed[x].reshape(len(x), -1)
        places = x.shape[1] - self.widest + 1
        return np.lib.stride_tricks.as_strided(
            e, (len(x), places, self.widest * self.size),
            (e.strides[0], 4 * self.size, 4), writeable=False).reshape(-1, self.widest * self.size)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), "f4")
        for i in range(0, len(x), BATCH):
            part = x[i:i + BATCH]
            top = (self._fields(part) @ self.kernel).reshape(len(part), -1, self.kernel.shape[1]).max(1)
            z = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[i:i + BATCH] = z / z.sum(1, keepdims=True)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, step: float = 0.004,
            decay: float = 1e-4) -> "ByteNet":
        rng = np.random.default_rng(self.seed + 1)
        names = ("embed", "kernel", "bias", "out", "out_bias")
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                part = order[i:i + 64]
                grads = self._gradients(x[part], y[part])
                t += 1
                for k in names:
                    p, g = getattr(self, k), grads[k] + decay * getattr(self, k)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p -= step * (first[k] / (1 - 0.9 ** t)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
                self.kernel *= self.mask
                self.embed[0] = 0
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, k = len(x), self.kernel.shape[1]
        fields = self._fields(x)
        answers = (fields @ self.kernel).reshape(n, -1, k)
        at = answers.argmax(1)
        pooled = np.take_along_axis(answers, at[:, None], 1)[:, 0] + self.bias
        active = np.maximum(pooled, 0)
        z = active @ self.out + self.out_bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out.T) * (pooled > 0)
        best = fields.reshape(n, -1, fields.shape[1])[np.arange(n)[:, None], at]  # n, k, field
        kernel = np.einsum("nkf,nk->fk", best, back) * self.mask
        into = back[:, :, None] * self.kernel.T[None]  # n, k, field
        places = at[:, :, None] + np.arange(self.widest)
        chars = x[np.arange(n)[:, None, None], places]
        embed = np.zeros_like(self.embed)
        np.add.at(embed, chars.ravel(), into.reshape(-1, self.size))
        return {"embed": embed, "kernel": kernel, "bias": back.sum(0),
                "out": active.T @ p, "out_bias": p.sum(0)}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(labelled: DataFrame) -> ByteNet | None:
    """Fit on ``labelled(doc_id, text, lang)``; None without a usable row."""
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    # one row a language
    counts = [(r[0], r[1]) for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    if not counts:
        return None
    share = F.create_map(*[x for lang, n in counts for x in (F.lit(lang), F.lit(float(n)))])
    u = uniform("doc_id", F.lit(1))
    start = F.pmod(F.xxhash64("doc_id", F.lit(2)),
                   F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int") + 1
    # small u * count: about the same number of documents of each language; bounded
    sample = (usable.select("doc_id", "lang", share[F.col("lang")].alias("n"),
                            u.alias("u"), F.substring(F.col("text"), start, F.lit(WINDOW)).alias("w"))
              .where(F.col("u") * F.col("n") <= 3 * PER_LANGUAGE).orderBy(F.col("u") * F.col("n"), "doc_id", "w")
              .limit(PER_LANGUAGE * len(counts)).select("lang", "w").collect())
    languages = sorted(lang for lang, _ in counts)
    rng = np.random.default_rng(3)
    x, y = [], []
    for lang, text in sample:
        full = windows(text)[0]
        short = full.copy()
        short[rng.integers(12, WINDOW):] = 0  # short texts occur too
        x += [full, short]
        y += [languages.index(lang)] * 2
    return ByteNet(languages).fit(np.array(x), np.array(y))


def predict(texts: list[str | None], model: ByteNet | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known, parts, size = [], [], 0
    for i, text in enumerate([*texts, None]):
        if i < len(texts) and model and text and any(map(str.isalpha, text)):
            known.append(i)
            parts.append(windows(text))
            size += len(parts[-1])
        if known and (size >= 8 * BATCH or i == len(texts)):
            n = np.array([len(p) for p in parts])
            p = np.add.reduceat(model.probabilities(np.concatenate(parts)).astype("f8"),
                                np.concatenate(([0], np.cumsum(n)[:-1]))) / n[:, None]
            best = p.argmax(1)
            score[known] = np.clip(p[np.arange(len(p)), best], 0, 1)
            for k, b in zip(known, best):
                lang[k] = model.languages[b]
            known, parts, size = [], [], 0
    return lang, score


def predict_language(documents: DataFrame, model: ByteNet | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every document."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for pdf in batches:
            lang, score = predict(list(pdf["text"]), model)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": lang, "score": score})

    return plain(documents, doc_id="long", text="string").mapInPandas(
        run, "doc_id long, lang_pred string, score double")


def identify(documents: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    rows = plain(documents, doc_id="long", text="string", lang="string")
    model = train(rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return predict_language(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identified(documents: DataFrame, least: float) -> DataFrame:
    """The documents, all columns, whose language is found with a score of
    ``least`` or more; the model as in :func:`identify`."""
    small_batches(documents.sparkSession)
    rows = plain(documents, doc_id="long", text="string", lang="string")
    model = train(rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            lang, score = predict(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array([one != UNKNOWN and s >= least for one, s in zip(lang, score)],
                                        pa.bool_()))
    return documents.mapInArrow(run, documents.schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
