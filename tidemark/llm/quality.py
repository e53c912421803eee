"""Quality classifier (operator 7): random Fourier features, ridge, isotonic calibration.

Statistics of each whole text (shares of kinds of characters and words, lengths, repetition) are made once.
A random Fourier map of the standardised statistics approximates a Gaussian kernel; each partition of the
labelled training rows adds up its part of the normal equations, a matrix of fixed size, and the driver solves
their sum (ridge). Ridge scores of the training rows, counted in ``BINS`` bins, are made monotone by pooling
neighbours that are out of order; a score is read off that curve. Model, bins and sums have fixed sizes;
everything that grows stays in Spark. Labels, language, source and ids are never inputs of a score.

Defined cases: null text counts as empty; an empty text has the statistics of no words and gets the score the
curve gives it. Labels without a text, null labels and labels of a held-out row are not learnt; of repeated
labels the smallest counts. Without any label the score is the share 0.5. Rows that repeat a doc_id each get a
row; a null doc_id is held in and not learnt. Texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ids_and_text, stored, table
from tidemark.llm.registry import register
from tidemark.llm.textnp import Words, blocks

WIDTH = 256  # random features
PARTS = 16  # partial sums of the normal equations
BINS = 2000
RIDGE = 1e-3
THRESHOLD = 0.7
STATS = 14


def statistics(column) -> np.ndarray:
    """One row of ``STATS`` numbers for each text."""
    w = Words(column)
    raw, off, texts = w.raw, w.offsets, len(w.offsets) - 1
    words = np.maximum(w.counts, 1)
    chars = np.maximum(np.diff(off), 1)
    letters = np.zeros(256, np.int64)
    letters[97:123], letters[65:91], letters[48:58] = 1, 2, 3
    letters[[ord(c) for c in "#$%&*@^~=+<>{}[]\\_"]] = 4
    letters[ord("|")], letters[ord("!")], letters[ord("\n")], letters[128:] = 5, 6, 7, 8
    letters[[ord(c) for c in ".,;:?"]] = 9
    owner = np.repeat(np.arange(texts), np.diff(off))
    kinds = np.bincount(owner * 10 + letters[raw], minlength=10 * texts).reshape(texts, 10)
    ascii_letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    size = (w.end - w.start).astype(np.float64)
    mean = np.bincount(w.text, size, texts) / words
    spread = np.sqrt(np.maximum(np.bincount(w.text, size ** 2, texts) / words - mean ** 2, 0))
    order = np.lexsort((w.hash, w.text))
    h, t = w.hash[order], w.text[order]
    again = np.bincount(t[1:][(h[1:] == h[:-1]) & (t[1:] == t[:-1])], minlength=texts) / words
    one = np.bincount(w.text, size == 1, texts) / words
    share = lambda k, of: np.log1p(50 * kinds[:, k] / of)
    return np.stack([np.log1p(w.counts), mean, spread, kinds[:, 2] / ascii_letters, share(3, chars), share(4, words),
                     share(5, words), share(6, words), share(7, words), kinds[:, 8] / chars, share(9, words), again, one,
                     np.minimum(size_max(w, size, texts), 100) / 10], 1)


def size_max(w: Words, size: np.ndarray, texts: int) -> np.ndarray:
    out = np.zeros(texts)
    np.maximum.at(out, w.text, size)
    return out


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id and stats (array of double) of every whole text, then the columns of ``carry``."""
    carry = carry or []

    def run(batches):
        for b in blocks(batches):
            x = statistics(b.column("text"))
            off = pa.array(np.arange(len(x) + 1, dtype=np.int32) * STATS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(off, pa.array(x.reshape(-1))),
                                              *[b.column(c) for c in carry]], names=["doc_id", "stats", *carry])

    rows = ids_and_text(docs, id_col, text_col, carry)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("stats", T.ArrayType(T.DoubleType())), *[rows.schema[c] for c in carry]]))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4 is 2."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


class Classifier:
    """Mean, scale, random map, weights and the calibration curve."""

    def __init__(self, seed: int = 17):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.map = rng.standard_normal((STATS, WIDTH)) / np.sqrt(STATS)
        self.phase = rng.uniform(0, 2 * np.pi, WIDTH)
        self.mean, self.scale = np.zeros(STATS), np.ones(STATS)
        self.weights = np.zeros(WIDTH + 1)
        self.at, self.value = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / WIDTH) * np.cos(z @ self.map + self.phase), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.value)


def isotonic(at: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares monotone curve through counted bins: places and values of the pooled blocks."""
    pools: list[list[float]] = []  # place x count, count, sum
    for x, k, s in zip(at, n, total):
        pools.append([x * k, k, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 1], p[:, 2] / p[:, 1]


def _matrix(batch, name: str = "stats") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATS)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        parts: int = PARTS, seed: int = 17) -> Classifier:
    """Learn from the labelled rows of ``stats`` that are not held out."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
             .where(F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y")))
    train = stored(stats.join(known, "doc_id").select("doc_id", "stats", "y").repartition(parts, "doc_id"), "train")
    model = Classifier(seed)
    first = train.select(*[F.struct(F.avg(F.col("stats")[i]), F.stddev_pop(F.col("stats")[i])) for i in range(STATS)]).first()
    if first[0][0] is None:
        return model
    model.mean = np.array([m for m, _ in first])
    model.scale = np.array([max(s, 1e-6) for _, s in first])

    def partial(batches):
        gram, right, n = np.zeros((WIDTH + 1, WIDTH + 1)), np.zeros(WIDTH + 1), 0
        for b in batches:
            x, y = model.features(_matrix(b)), b.column("y").to_numpy()
            gram, right, n = gram + x.T @ x, right + x.T @ y, n + len(y)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([right.tobytes()]), pa.array([n], pa.int64())],
                                         names=["gram", "rhs", "n"])

    gram, right, n = np.zeros((WIDTH + 1, WIDTH + 1)), np.zeros(WIDTH + 1), 0
    for r in train.select("stats", "y").mapInArrow(partial, "gram binary, rhs binary, n long").toLocalIterator():
        gram += np.frombuffer(r["gram"]).reshape(gram.shape)
        right += np.frombuffer(r["rhs"])
        n += r["n"]
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(WIDTH + 1) / WIDTH, right)

    @F.pandas_udf("int")
    def bin_of(stats_col):
        raw = model.raw(np.array(stats_col.tolist()).reshape(-1, STATS))
        import pandas as pd
        return pd.Series(np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32))

    bins = (train.select(bin_of("stats").alias("bin"), "y").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).toPandas().sort_values("bin"))
    model.at, model.value = isotonic((bins["bin"].to_numpy() + 0.5) * 2 / BINS - 0.5, bins["n"].to_numpy(float),
                                     bins["s"].to_numpy(float))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality", carry: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, then the columns of ``carry``."""
    carry = carry or []
    stats = stored(text_statistics(docs, id_col, text_col, carry), "stats")
    model = fit(stats, labels, id_col, label_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.clip(model.score(_matrix(b)), 0, 1)),
                                                  *[b.column(c) for c in carry]], names=["doc_id", "score", *carry])

    scored = stats.mapInArrow(run, T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType()), *[stats.schema[c] for c in carry]]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *carry)


@register("op7_fourier_ridge")
def op7_fourier_ridge(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
