"""Probability of a text over all its segmentations into subwords.

The pieces are those of an existing subword vocabulary; their unigram scores
are log probabilities of how often its own segmentation of the learning texts
uses them (plus one each). Pieces never reach over white space, so a text is
its words and an end, and a word's probability is a forward recursion in log
space over the lattice of all pieces that spell it, bytes included.

Word counts grow with the corpus and are a table. Each document is read twice:
once for counts, summed per task before they are shuffled, and once to be
scored. The HOT most frequent words go to every task as a bounded table; the
other words of a document are joined with the table by word, each document and
word once, and summed up per document.

Defined results: NULL text is empty and holds the end alone; NULL doc_id is
neither held out nor learned from; with nothing to learn from N and V are 0;
repeated rows are scored one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

HOT = 50_000
#: No word holds a space, so this names the end.
END, _END = " ", b" "
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A task counts words of up to so many bytes of text before it passes the counts on.
COUNT_BYTES = 1 << 24
#: Distinct words whose recursion a task takes.
WORDS_PER_TASK = 100_000


def split_words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 with A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


def text_words(text: str | None) -> list[str]:
    """The same words of a string."""
    return [w.decode() for w in split_words((text or "").encode())]


class Lattice:
    """Marginal log10 probability of words under unigram piece scores."""

    def __init__(self, pieces: list[str], is_byte: list[int], scores: np.ndarray, end: int):
        self.score = {p: float(s) for p, b, s in zip(pieces, is_byte, scores) if b < 0 and p}
        self.byte = {b: float(s) for b, s in zip(is_byte, scores) if b >= 0}
        self.end = float(scores[end])
        self.pieces = ahocorasick.Automaton()
        for p, v in self.score.items():
            self.pieces.add_word(p, (len(p), v))
        self.pieces.make_automaton()

    def word(self, word: str) -> float:
        text = "▁" + word
        n, score = len(text), self.score
        # Pieces by the place they end at; a character that is no piece is spelt by its bytes.
        ways = [[] for _ in range(n)]
        for last, way in self.pieces.iter(text) if len(self.pieces) else ():
            ways[last].append(way)
        # forward[i]: log probability of the first i characters over all segmentations.
        forward = [0.0] * (n + 1)
        for i, found in enumerate(ways):
            logs = [forward[i + 1 - size] + s for size, s in found]
            if text[i] not in score:
                logs.append(forward[i] + sum(self.byte.get(x, -20.0) for x in text[i].encode("utf-8", "surrogatepass")))
            if len(logs) == 1:
                forward[i + 1] = logs[0]
            else:
                top = max(logs)
                forward[i + 1] = top + math.log(sum([math.exp(x - top) for x in logs])) if top > -math.inf else top
        return forward[n] / math.log(10)


@cache
def vocabulary(path: str):
    """Processor, pieces, byte value of byte pieces (else -1, or -2 for control pieces), id of the end piece."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
    kinds = [int(s[3:5], 16) if p.is_byte(i) else -2 if p.is_control(i) or p.is_unknown(i) else -1 for i, s in enumerate(pieces)]
    return p, [s if k != -2 else "" for s, k in zip(pieces, kinds)], kinds, p.eos_id()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n (over learning rows, the end included), of every word of any row. docs: text_key, text, learn."""

    def count(batches):
        held, seen = 0, {}

        def flush():
            ws = pa.array(list(seen), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([ws, pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for some in frames.chunks(batch):
                texts = some.column("text").cast(pa.binary()).to_pylist()
                for text, learn in zip(texts, some.column("learn").to_pylist()):
                    own = split_words(text)
                    if learn:
                        for w, n in Counter(own).items():
                            seen[w] = seen.get(w, 0) + n
                        seen[_END] = seen.get(_END, 0) + 1
                    else:
                        for w in own:
                            seen.setdefault(w, 0)
                held += sum(len(t or b"") for t in texts)
                if held > COUNT_BYTES or len(seen) > 400_000:
                    yield flush()
                    held, seen = 0, {}
        if seen:
            yield flush()

    return frames.arrow_map(docs.select("text", "learn"), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece_scores(counts: DataFrame, path: str) -> np.ndarray:
    """Log probability of every piece; the table that reaches the driver has a row per piece of the vocabulary."""

    def cut(batches):
        p = vocabulary(path)[0]
        for batch in batches:
            total = Counter()
            ws, ns = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            for ids, n in zip(p.encode(ws, num_threads=1), ns):
                for i in ids:
                    total[i] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["piece", "n"])

    size = len(vocabulary(path)[1])
    used = np.ones(size)
    learned = counts.filter((F.col("n") > 0) & (F.col("word") != END))
    for r in frames.arrow_map(learned, cut, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        used[r["piece"]] += r["n"]
    ends = counts.filter(F.col("word") == END).collect()
    used[vocabulary(path)[3]] += ends[0]["n"] if ends else 0
    return np.log(used / used.sum())


def _parts(words: int) -> int:
    """Tasks for the recursion: it costs by the word, which a number of partitions by bytes does not see."""
    return max(1, -(-words // WORDS_PER_TASK))


def score(docs: DataFrame, vocabulary_path: str, learn: Column | None = None) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. `learn`: rows to learn from (default: crc32(doc_id) mod 7 is not 2)."""
    spark = docs.sparkSession
    may = F.coalesce(frames.bucket(F.col("doc_id"), 7) != 2, F.lit(False)) if learn is None else learn
    held = F.coalesce(frames.bucket(F.col("doc_id"), 7) == 2, F.lit(False)) if learn is None else ~learn
    rows = frames.keyed(docs).withColumn("learn", may).withColumn("held_out", held)
    counts = materialize(word_counts(rows), "word_counts")
    n, v = counts.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    scores = piece_scores(counts, vocabulary_path)
    shared = spark.sparkContext.broadcast(scores)

    def weigh(batches):
        _, pieces, kinds, end = vocabulary(vocabulary_path)
        lattice = Lattice(pieces, kinds, shared.value, end)
        for batch in batches:
            logs = [lattice.end / math.log(10) if w == END else lattice.word(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(logs, pa.float64())], names=["word", "n", "lp"])

    weighed = materialize(frames.arrow_map(counts.repartition(_parts(counts.count()), "word"), weigh, "word string, n long, lp double"), "word_scores")
    top = weighed.orderBy(F.desc("n"), "word").limit(HOT).toArrow()
    hot = {w.encode(): (c > 0, math.log10(c + 1), lp) for w, c, lp in zip(top["word"].to_pylist(), top["n"].to_pylist(), top["lp"].to_pylist())}
    hot = spark.sparkContext.broadcast(hot)

    def first_sums(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])
        known = hot.value
        for batch in batches:
            for some in frames.chunks(batch):
                out = []
                for text in some.column("text").cast(pa.binary()).to_pylist():
                    own = Counter(split_words(text))
                    tokens = sum(own.values()) + 1
                    own[_END] += 1
                    got = [(k, *known[w]) for w, k in own.items() if w in known]
                    rare = [w for w in own if w not in known]
                    out.append((tokens, sum([k for k, is_known, _, _ in got if is_known]), math.fsum([k * lc for k, _, lc, _ in got]), math.fsum([k * lp for k, _, _, lp in got]), rare, [own[w] for w in rare]))
                made = [pa.array(c, t) for c, t in zip(zip(*out), schema.types[3:])]
                made[4] = made[4].cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([some.column(c) for c in ("doc_id", "text_key", "held_out")] + made, names=schema.names)

    first = frames.arrow_map(
        rows.select("doc_id", "text_key", "held_out", "text"), first_sums,
        "doc_id long, text_key long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<string>, times array<int>",
    )
    # Rows may repeat; each has a number of its own, stored before it is joined on.
    first = materialize(first.withColumn("row", F.monotonically_increasing_id()), "first_sums")
    each = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    # Every word of a document is in the table but the end, where nothing was learned.
    joined = each.join(weighed, "word", "left")
    n_word = F.coalesce("n", F.lit(0))
    more = joined.groupBy("row").agg(
        F.sum(F.when(n_word > 0, F.col("times")).otherwise(0)).cast("long").alias("more_known"),
        F.sum(F.col("times") * F.log10(n_word + 1)).alias("more_logs"),
        F.sum(F.col("times") * F.coalesce("lp", F.lit(float(scores[vocabulary(vocabulary_path)[3]] / math.log(10))))).alias("more_score"),
    )
    out = first.drop("rare", "times").join(more, "row", "left")
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
