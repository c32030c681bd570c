"""Language identification with a blended-spectrum string kernel.

A text is the set of its character n-grams (all orders up to ORDERS, lower
case, each gram hashed to one of GRAMS places). The kernel of two texts is the
number of grams both have, over the root of the product of their sizes. Some
training texts are Nystroem landmarks, ridge regression (one language against
the rest) is solved in the space they span. As the kernel is linear in the
set of grams, landmarks and coefficients fold into one matrix of grams and
languages, and texts are scored by products of that matrix with one of a block
of texts and their grams.

The sample is bounded: about LANDMARKS texts as landmarks and TRAINING texts in
all, shared evenly between languages, chosen by a hash of the id. What reaches
the driver is one bit set of GRAMS bits for each.

Defined results: NULL text or text without a letter is `und` with score 0; with
no training texts every text is `und`; an empty table gives no rows; NULL doc_id
is neither held out nor learned from; repeated rows are scored one by one; ties
go to the language that sorts first; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames

GRAMS = 1 << 16
ORDERS = 3
LANDMARKS = 256
TRAINING = 1600
RIDGE = 0.05
# Texts scored by one matrix product: 32 MB if each has grams at all places.
BLOCK = 64
UNKNOWN = "und"
_LETTER = re.compile(r"[A-Za-z]")


def gram_set(text: str) -> np.ndarray:
    """Places of the text's n-grams, each once. The whole text counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(GRAMS, dtype=bool)
    code = np.zeros(len(points), dtype=np.uint32)
    for n in range(1, ORDERS + 1):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] + np.uint32(n)) * np.uint32(0x9E3779B1) + points[n - 1 :]
        h = code ^ (code >> np.uint32(15))
        seen[(h * np.uint32(0x85EBCA77)) >> np.uint32(16)] = True
    return np.flatnonzero(seen)


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LETTER.search(text) is not None or any(c.isalpha() for c in text))


class Model:
    """Weights per gram and language."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression values, a row per text: the batch's kernel rows times the coefficients."""
        out = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(texts), BLOCK):
            sets = [gram_set(text) for text in texts[start : start + BLOCK]]
            # Only places that a text of the block has are columns of the block's matrix.
            used = np.unique(np.concatenate(sets))
            rows = np.zeros((len(sets), len(used)))
            for row, grams in zip(rows, sets):
                if len(grams):
                    row[np.searchsorted(used, grams)] = 1.0 / np.sqrt(len(grams))
            out[start : start + BLOCK] = rows @ self.weights[used]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        names, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            values = self.scores([texts[i] for i in known])
            best = values.argmax(axis=1)
            for i, k, row in zip(known, best, values):
                names[i], sure[i] = self.languages[k], float(min(1.0, max(0.0, row[k])))
        return names, sure


def _unit_rows(bits: list[bytes]) -> np.ndarray:
    """Gram sets as rows, each divided by the root of its size."""
    x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1)
    return x.astype(np.float32) / np.sqrt(x.sum(axis=1, dtype=np.float32, keepdims=True))


def train(rows: DataFrame) -> Model:
    """From rows (doc_id, text, lang). See the module for the bounded sample."""
    labelled = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((GRAMS, 0)))
    share = max(1, TRAINING // len(languages))
    rate = F.lit(0)
    for lang in languages:
        rate = F.when(F.col("lang") == lang, frames.hash_rate(counts[lang], share)).otherwise(rate)
    chosen = labelled.filter(frames.hashed_below(F.col("doc_id"), rate))

    def grams(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                bits = []
                for text in some.column("text").to_pylist():
                    seen = np.zeros(GRAMS, np.uint8)
                    seen[gram_set(text)] = 1
                    bits.append(np.packbits(seen).tobytes())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("lang"), pa.array(bits, pa.binary())], names=["doc_id", "lang", "bits"])

    sample = sorted(((r["doc_id"], r["lang"], bytes(r["bits"])) for r in frames.arrow_map(chosen, grams, "doc_id long, lang string, bits binary").collect()), key=lambda r: (r[0], r[1], r[2]))
    sample = [s for s in sample if any(s[2])]
    if not sample:
        return Model([], np.zeros((GRAMS, 0)))
    marks = _unit_rows([sample[i][2] for i in np.unique(np.linspace(0, len(sample) - 1, min(LANDMARKS, len(sample))).astype(int))])
    # Kernel rows of the sample against the landmarks, a batch at a time.
    kernel = np.concatenate([_unit_rows([s[2] for s in sample[i : i + 128]]) @ marks.T for i in range(0, len(sample), 128)]).astype(np.float64)
    y = np.array([[float(s[1] == lang) for lang in languages] for s in sample])
    # Nystroem features: kernel values against the landmarks times the inverse root of the landmarks' own kernel.
    own = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel @ root
    weight = 1.0 / np.maximum(y.sum(axis=0), 1.0)
    rows_weight = (y * weight).sum(axis=1) * len(y) / max(1, len(languages))
    zw = z * rows_weight[:, None]
    coefficients = np.linalg.solve(zw.T @ z + RIDGE * len(z) / len(languages) * 0.01 * np.eye(z.shape[1]), zw.T @ y)
    return Model(languages, (marks.T @ (root @ coefficients).astype(np.float32)).astype(np.float64))


def predicted(model: Model, spark) -> callable:
    """Column function: text to (lang_pred, score)."""
    frames.ship(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.weights))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        own = Model(*shared.value)
        names, sure = [], []
        for some in frames.chunks(pa.RecordBatch.from_arrays([texts], names=["text"])):
            a, b = own.predict(some.column(0).to_pylist())
            names += a
            sure += b
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())], names=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. `learn` says which rows may be learned from (default: crc32(doc_id) mod 4 is not 2)."""
    held = F.coalesce(frames.bucket(F.col("doc_id"), 4) == 2, F.lit(False)) if learn is None else ~learn
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(rows.filter(~held))
    predict = predicted(model, docs.sparkSession)
    scored = rows.select("doc_id", held.alias("held_out"), predict("text").alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")


def in_known_language(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """`docs` without the rows that no language is found for: NULL texts and texts without a letter."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    may = F.coalesce(frames.bucket(F.col("doc_id"), 4) != 2, F.lit(False)) if learn is None else learn
    predict = predicted(train(own.filter(may)), docs.sparkSession)
    return docs.filter(predict(F.col("text").cast("string"))["lang_pred"] != UNKNOWN)
