"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

Each class has discounted counts of ORDER-character sequences in its words;
all lower orders are continuation counts shared by both classes, so an
expression that a class has not seen is as likely in both. A word's value is
its toxic less its ordinary log-likelihood, per character. A text's values are
the mean over all its words and the mean of its TOP highest words, which stay
the same however long the text is around them. A logistic curve on these two
gives the score; it is fitted on values of texts that the models behind them
have not seen, FOLDS times a part of the sample by models of the other parts.

All is fitted on a bounded sample: of each class about SAMPLE labelled texts,
chosen by a hash of the id. What reaches the driver is the sample's words with
the number of texts that hold them, and two numbers per text.

Defined results: texts without words, NULL ones included, score as the curve
has it for no evidence; with labels of one class only every score is 0 or 1;
with no labels it is 0; a document with several labels counts as toxic if one
says so; NULL labels and NULL ids are not learned from; NULL doc_id is not held
out; repeated rows are scored one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

ORDER = 5
#: Discounts of continuation counts, and of class counts of one, two, and three or more: one text alone says nothing of a class.
DISCOUNT = 0.75
CLASS_DISCOUNTS = (1.0, 1.6, 2.2)
TOP = 3
SAMPLE = 1500
FOLDS = 3
#: Words, and character sequences, whose values a worker remembers.
CACHED = 300_000
_WORD = re.compile(r"[^\W_]+")


class Model:
    """Kneser-Ney models of the classes 0 (ordinary) and 1 (toxic) from (word, class) counts."""

    def __init__(self, counts: dict[tuple[str, int], int], curve: tuple[float, float, float] | None = None):
        self.curve = curve
        self.full: tuple[dict, dict] = (defaultdict(int), defaultdict(int))
        for (word, label), n in counts.items():
            padded = "^" * (ORDER - 1) + word + "$"
            own = self.full[label]
            for i in range(len(word) + 1):
                own[padded[i : i + ORDER]] += n
        self.full = (dict(self.full[0]), dict(self.full[1]))
        # Continuation counts of the lower orders, over both classes.
        self.lower: list[dict[str, int]] = [{} for _ in range(ORDER)]
        grams = set(self.full[0]) | set(self.full[1])
        for size in range(ORDER - 1, 0, -1):
            shorter = Counter(g[1:] for g in grams)
            self.lower[size] = dict(shorter)
            grams = set(shorter)
        self.contexts = [self._class_contexts(self.full[c]) for c in (0, 1)]
        self.lower_contexts = [self._contexts(d) for d in self.lower]
        self.letters = max(2, len(self.lower[1]) + 1)
        self.words: dict[str, float] = {}
        self.ratios: dict[str, float] = {}

    @staticmethod
    def _contexts(grams: dict[str, int]) -> dict[str, tuple[int, int]]:
        total: dict[str, list[int]] = {}
        for g, n in grams.items():
            t = total.setdefault(g[:-1], [0, 0])
            t[0] += n
            t[1] += 1
        return {k: (a, b) for k, (a, b) in total.items()}

    @staticmethod
    def _discount(n: int) -> float:
        return CLASS_DISCOUNTS[min(n, 3) - 1] if n else 0.0

    @classmethod
    def _class_contexts(cls, grams: dict[str, int]) -> dict[str, tuple[int, float]]:
        """Per context the number of its continuations, and what the discounts take from them."""
        total: dict[str, list] = {}
        for g, n in grams.items():
            t = total.setdefault(g[:-1], [0, 0.0])
            t[0] += n
            t[1] += cls._discount(n)
        return {k: (a, b) for k, (a, b) in total.items()}

    def _given(self, c: int, gram: str, shared: float) -> float:
        """P(last character | those before it, class): what is discounted goes to the shared value."""
        context = self.contexts[c].get(gram[:-1])
        if context is None:
            return shared
        n = self.full[c].get(gram, 0)
        return (n - self._discount(n) + context[1] * shared) / context[0]

    def _shared(self, gram: str) -> float:
        """P(last character | those before it) from the shared counts of this order and below."""
        p = 1.0 / self.letters
        for size in range(1, ORDER):
            g = gram[-size:]
            context = self.lower_contexts[size].get(g[:-1])
            if context is None:
                break
            n = self.lower[size].get(g, 0)
            p = (max(n - DISCOUNT, 0.0) + DISCOUNT * context[1] * p) / context[0]
        return p

    def log_ratio(self, gram: str) -> float:
        """log P(last character | those before it, toxic) less the same of the ordinary class."""
        shared = self._shared(gram[1:])
        return math.log(self._given(1, gram, shared)) - math.log(self._given(0, gram, shared))

    def _ratio(self, gram: str) -> float:
        # A context that neither class has seen leaves both at the shared value.
        value = self.log_ratio(gram) if gram[:-1] in self.contexts[0] or gram[:-1] in self.contexts[1] else 0.0
        if len(self.ratios) < CACHED:
            self.ratios[gram] = value
        return value

    def word(self, word: str) -> float:
        """Toxic less ordinary log-likelihood per character, the end included."""
        padded = "^" * (ORDER - 1) + word + "$"
        ratios = self.ratios
        total = 0.0
        for i in range(len(word) + 1):
            gram = padded[i : i + ORDER]
            total += ratios[gram] if gram in ratios else self._ratio(gram)
        return total / (len(word) + 1)

    def _token(self, token: str) -> float:
        parts = _WORD.findall(token)
        value = max((self.word(p) for p in parts), default=0.0)
        if len(self.words) < CACHED:
            self.words[token] = value
        return value

    def features(self, text: str | None) -> tuple[float, float]:
        tokens = text.lower().split() if text else []
        if not tokens:
            return 0.0, 0.0
        known = self.words
        values = np.array([known[t] if t in known else self._token(t) for t in tokens])
        top = np.partition(values, len(values) - TOP)[-TOP:] if len(values) > TOP else values
        return float(values.mean()), float(np.maximum(top, 0.0).sum() / TOP)

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, a + b * x + c * y))))


def fit_curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton steps; classes weigh the same."""
    x = np.column_stack((np.ones(len(features)), features))
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    x = x / scale
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    w = np.zeros(3)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - labels)) + 0.1 * w * [0, 1, 1]
        hessian = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + 0.1 * np.diag([1e-3, 1, 1])
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    a, b, c = w / scale
    return float(a), float(b), float(c)


def labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, text, toxic of the rows that may be learned from."""
    one = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = docs.filter(learn & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(one, F.col("doc_id") == F.col("_id")).drop("_id")


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """The models and the curve, from a bounded sample. See the module."""
    # Classes are counted, and rows chosen, without their texts.
    ids = labelled(docs.select("doc_id", F.lit("").alias("text")), labels, learn).select("doc_id", "toxic").distinct()
    sizes = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Model({}, (60.0 if 1 in sizes else -60.0, 0.0, 0.0))
    rate = F.when(F.col("toxic") == 1, frames.hash_rate(sizes[1], SAMPLE)).otherwise(frames.hash_rate(sizes[0], SAMPLE))
    chosen = ids.filter(frames.hashed_below(F.col("doc_id"), rate))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    kept = {(r["doc_id"], r["toxic"]): r["fold"] for r in chosen.withColumn("fold", fold).collect()}
    picked = docs.sparkSession.sparkContext.broadcast({i: (y, f) for (i, y), f in kept.items()})

    @F.arrow_udf("boolean")
    def in_sample(ids: pa.Array) -> pa.Array:
        return pa.array([i in picked.value for i in ids.to_pylist()])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL").filter(in_sample("doc_id"))
    # The sample is small; it is stored, so that the table is read for it once.
    rows = materialize(rows, "sample").coalesce(4)

    def count(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                seen = Counter()
                for i, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    seen.update((w, *picked.value[i]) for w in set(_WORD.findall(text.lower())))
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), *[pa.array([k[j] for k in seen], pa.int32()) for j in (1, 2)], pa.array(list(seen.values()), pa.int64())], names=["word", "toxic", "fold", "n"])

    counted = frames.arrow_map(rows, count, "word string, toxic int, fold int, n long").groupBy("word", "toxic", "fold").agg(F.sum("n").alias("n")).toArrow()
    counted = list(zip(*[counted[c].to_pylist() for c in ("word", "toxic", "fold", "n")]))

    def model_without(fold: int | None) -> Model:
        counts = Counter()
        for word, label, part, n in counted:
            if part != fold:
                counts[word, label] += n
        return Model(counts)

    features, classes = [], []
    for fold in range(FOLDS):
        if {y for y, f in picked.value.values() if f != fold} != {0, 1}:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(model_without(fold))

        def evidence(batches, fold=fold, shared=shared):
            for batch in batches:
                for some in frames.chunks(batch):
                    own = [(picked.value[i][0], t) for i, t in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()) if picked.value[i][1] == fold]
                    found = [(y, *shared.value.features(t)) for y, t in own]
                    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int32(), pa.float64(), pa.float64()))], names=["toxic", "mean", "top"])

        seen = frames.arrow_map(rows, evidence, "toxic int, mean double, top double").toArrow()
        shared.destroy()
        classes += seen["toxic"].to_pylist()
        features += zip(seen["mean"].to_pylist(), seen["top"].to_pylist())
    model = model_without(None)
    if set(classes) != {0, 1}:
        # Too few texts to hold some back: one word that only the toxic class has tips the scale.
        model.curve = (-3.0, 0.0, 12.0)
    else:
        model.curve = fit_curve(np.array(features), np.array(classes))
    return model


def toxic_scores(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. `learn`: rows to learn from (default: crc32(doc_id) mod 5 is not 0)."""
    spark = docs.sparkSession
    frames.ship(spark)
    may = F.coalesce(frames.bucket(F.col("doc_id"), 5) != 0, F.lit(False)) if learn is None else learn
    held = F.coalesce(frames.bucket(F.col("doc_id"), 5) == 0, F.lit(False)) if learn is None else ~learn
    shared = spark.sparkContext.broadcast(train(docs, labels, may))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for some in frames.chunks(pa.RecordBatch.from_arrays([texts], names=["text"])):
            out += map(shared.value.score, some.column(0).to_pylist())
        return pa.array(out, pa.float64())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
