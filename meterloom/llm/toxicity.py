"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts.

Two bigram models, of toxic and of ordinary texts, are smoothed by absolute discounting down to one
continuation distribution that both share:

    shared(w) = (contexts(w) + 0.5) / (T + 0.5 (V + 1))           distinct words before w, in either class
    P_q(w)    = (max(c_q(w) - D, 0) + D N_q shared(w)) / C_q       N_q distinct words, C_q tokens of class q
    P_q(w|v)  = (max(c_q(v,w) - D, 0) + D N_q(v) P_q(w)) / c_q(v)  P_q(w) where q never saw v

With D = 1 an expression that a class has once weighs as the shared counts say, so rare expressions, of which
the smaller class lacks most, tell the classes apart no more than unseen ones. A toxic text holds but few toxic
expressions, so its likelihood is that of a mixture: each word comes from the toxic model with probability
``share``, else from the ordinary one. The score compares log-likelihoods by the mean a word of

    log(1 - share + share * P_1 / P_0)

of bigrams and of words alone. Log-odds for these two and the logarithm of the length are fitted on training rows
set aside, weighted to the classes' true sizes.

Bounds: the models are fitted on a sample of labelled rows, at most about ``sample_rows`` a class (by a hash of
the id; all rows if there are fewer), texts of up to ``sample_text`` characters, equal texts once, and in hash
order up to ``sample_chars`` characters a class. N-grams are counted by Spark; words and bigrams that a class
has twice or more reach the driver and are broadcast: at most sample_chars / 2 of each, in practice some 10 MB.
Every text is scored whole.

Defined results: a null text is empty; an empty text has means of 0 and the score that its length gives; labels
other than 0 and 1 and labels without a document teach nothing; of an id with several labels or several texts each pair teaches;
without labels of both classes all scores are the share of toxic labels (0.5 without any); an empty table gives
no rows; only doc_id and text, and of the labels doc_id and the named column, are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import remainder, stored, text_key, tidy

_WORD = re.compile(r"[^\W\d_]+")
_TEXTS = 256  # that are scored at a time
_START = ""  # the context of a text's first word
DISCOUNT = 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def training_sample(
    docs: DataFrame, labels: DataFrame, training: Column, label: str, *, rows: int, text: int, chars: int
) -> tuple[DataFrame, dict[int, int]]:
    """text, toxic and fold (0 to 4) of the sampled rows; and the number of labelled training rows by class."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = stored(known.where(training).distinct(), "toxic-labels")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    chance = F.when(F.col("toxic") == 1, rows / max(1, sizes.get(1, 0))).otherwise(rows / max(1, sizes.get(0, 0)))
    chosen = stored(known.where(place < chance), "toxic-chosen")
    found = docs.select("doc_id", "text").where(F.length("text") <= text).join(chosen, "doc_id")
    found = found.groupBy(text_key(F.col("text")).alias("key"), "toxic").agg(F.first("text").alias("text"))
    found = stored(found, "toxic-texts")
    order = Window.partitionBy("toxic").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    kept = found.select("key", "toxic", F.sum(F.length("text")).over(order).alias("sum")).where(F.col("sum") <= chars)
    fold = F.pmod(F.xxhash64("key"), F.lit(5)).cast("int").alias("fold")
    return stored(found.join(kept, ["key", "toxic"], "left_semi").select("text", "toxic", fold), "toxic-sample"), sizes


def _grams(sample: DataFrame) -> DataFrame:
    """v, w (v is null for words alone) with their occurrences in ordinary and toxic texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                counts[toxic].update((None, w) for w in words)
                counts[toxic].update(zip([_START, *words[:-1]], words, strict=True))
        for toxic, found in counts.items():
            rows = list(found.items())
            for i in range(0, len(rows), 50_000):
                part = rows[i : i + 50_000]
                n = [c for _, c in part]
                zero = [0] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g, _ in part], pa.string()), pa.array([g[1] for g, _ in part], pa.string()),
                     pa.array(zero if toxic else n, pa.int64()), pa.array(n if toxic else zero, pa.int64())],
                    ["v", "w", "n0", "n1"],
                )

    parts = sample.select("text", "toxic").mapInArrow(tidy(counted), "v string, w string, n0 long, n1 long")
    return parts.groupBy("v", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass
class Models:
    """Both models: what scoring needs of each word and bigram, as log-free probabilities."""

    share: float
    ids: dict[str, int] = field(default_factory=lambda: {_START: 1})
    #: By word id (0: any other word): P_q(w), and the backoff weight N_q(v) / c_q(v).
    one: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    back: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    #: Sorted keys of bigrams and their discounted relative frequencies.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    two: np.ndarray = field(default_factory=lambda: np.zeros((2, 1)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Mean mixture log-ratios a word, of bigrams and of words, and log(1 + words), a row a text."""
        ids, lengths = [], []
        for text in texts:
            words = words_of(text)
            lengths.append(len(words))
            ids.append(np.fromiter(map(self.ids.get, words, [0] * len(words)), np.int64, len(words)))
        n = np.array(lengths, np.int64)
        w = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        if not len(w):
            return np.zeros((len(texts), 3))
        v = np.concatenate(([1], w[:-1]))
        starts = np.concatenate(([0], np.cumsum(n)[:-1]))
        v[starts[n > 0]] = 1
        keys = v * self.one.shape[1] + w
        at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        known = self.pairs[at] == keys if len(self.pairs) else np.zeros(len(keys), bool)
        one = self.one[:, w]
        two = np.where(known, self.two[:, at], 0.0) + self.back[:, v] * one
        out = np.zeros((len(texts), 3))
        for k, p in enumerate((two, one)):
            ratio = np.log1p(self.share * (p[1] / p[0] - 1))
            sums = np.bincount(np.repeat(np.arange(len(n)), n), ratio, len(n))
            out[:, k] = sums / np.maximum(n, 1)
        out[:, 2] = np.log1p(n)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        odds = _scaled(features) @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _scaled(features: np.ndarray) -> np.ndarray:
    """Features of about one unit with a constant."""
    return np.column_stack((np.ones(len(features)), 100 * features[:, :2], features[:, 2] / 5))


def fitted_odds(features: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    x, beta = _scaled(features), np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        slope = x.T @ (weight * (toxic - p)) - ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(4)
        step = np.linalg.solve(curve, slope)
        beta += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label: str = "toxic",
    *,
    share: float = 0.01,
    sample_rows: int = 8_000,
    sample_text: int = 50_000,
    sample_chars: int = 24_000_000,
) -> Models:
    """Models of the labels where the column ``training`` (of doc_id) holds."""
    sample, sizes = training_sample(docs, labels, training, label, rows=sample_rows, text=sample_text, chars=sample_chars)
    taken = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    all_ = sum(sizes.values())
    model = Models(share)
    if not taken.get(0) or not taken.get(1):
        rate = min(max(sizes.get(1, 0) / all_, 1e-6), 1 - 1e-6) if all_ else 0.5
        model.weights[0] = np.log(rate / (1 - rate))
        return model

    # Every fifth text is set aside for the log-odds.
    grams = stored(_grams(sample.where("fold > 0")), "toxic-grams")
    alone, pairs = grams.where("v IS NULL").drop("v"), grams.where("v IS NOT NULL")
    seen = lambda q: F.sum((F.col(f"n{q}") > 0).cast("long")).alias(f"d{q}")
    totals = alone.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), seen(0), seen(1), F.count("*").alias("words")).first()
    kinds = pairs.count()
    before = pairs.groupBy("w").agg(F.count("*").alias("contexts"))
    after = pairs.groupBy("v").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), seen(0), seen(1)).withColumnRenamed("v", "w")
    often = (F.col("n0") > DISCOUNT) | (F.col("n1") > DISCOUNT)
    words = alone.where(often).join(before, "w").join(after, "w", "left").orderBy("w").toArrow().to_pydict()
    start = after.where(F.col("w") == _START).first()

    model.ids |= {w: 2 + i for i, w in enumerate(words["w"])}
    n = len(words["w"])
    zero = lambda x: np.array([0 if y is None else y for y in x], float)
    spread = kinds + 0.5 * (totals["words"] + 1)
    # Other words have some number of contexts; it cancels in the ratio.
    shared = np.concatenate(([0.5, 0.5], np.array(words["contexts"], float) + 0.5)) / spread
    model.one, model.back = np.zeros((2, n + 2)), np.ones((2, n + 2))
    for q in (0, 1):
        tokens = max(1, totals[f"n{q}"] or 0)
        own = np.concatenate(([0, 0], np.maximum(np.array(words[f"n{q}"], float) - DISCOUNT, 0)))
        model.one[q] = (own + DISCOUNT * max(1, totals[f"d{q}"]) * shared) / tokens
        context, distinct = zero(words[f"c{q}"]), zero(words[f"d{q}"])
        model.back[q, 2:] = np.where(context > 0, DISCOUNT * distinct / np.maximum(context, 1), 1)
        if start and start[f"c{q}"]:
            model.back[q, 1] = DISCOUNT * start[f"d{q}"] / start[f"c{q}"]
    kept = pairs.where(often).join(after.select(F.col("w").alias("v"), "c0", "c1"), "v").toArrow().to_pydict()
    keys = np.array([model.ids.get(v, 0) * (n + 2) + model.ids.get(w, 0) for v, w in zip(kept["v"], kept["w"], strict=True)], np.int64)
    order = np.argsort(keys)
    model.pairs = keys[order]
    model.two = np.zeros((2, max(1, len(keys))))
    for q in (0, 1):
        share_ = np.maximum(zero(kept[f"n{q}"]) - DISCOUNT, 0) / np.maximum(zero(kept[f"c{q}"]), 1)
        model.two[q, : len(keys)] = share_[order]

    aside = sample.where("fold = 0").select("text", "toxic").toArrow().to_pydict()  # a fifth of the bounded sample
    toxic = np.array(aside["toxic"], float)
    weight = np.where(toxic == 1, sizes[1] / taken[1], sizes[0] / taken[0]) * sum(taken.values()) / all_
    parts = [model.features(aside["text"][i : i + _TEXTS]) for i in range(0, len(toxic), _TEXTS)]
    model.weights = fitted_odds(np.concatenate(parts) if parts else np.zeros((0, 3)), toxic, weight)
    return model


def score_texts(docs: DataFrame, model: Models) -> DataFrame:
    """doc_id and score of every document."""
    kind = dict(docs.dtypes)["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(i, _TEXTS)
                scores = own.score(own.features(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidy(scored), f"doc_id {kind}, score double")


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    scores = score_texts(docs, fit(docs, labels, ~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
