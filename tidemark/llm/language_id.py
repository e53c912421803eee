"""Language ID (operator 11): word-first backoff.

Words are runs of letters and marks, lower-cased. A word that the model knows adds, for each language, the
logarithm of its smoothed share among that language's words. For an unseen word the character n-grams of the word with a
blank at both ends take its place: those of ``LONGEST`` characters, or if the model knows none of them those of
one character less, and so on; the mean logarithm of the known ones is added, so an unseen word weighs as one word. A word of
which not even a letter is known adds nothing. The language with the highest sum wins (the first by name among equal ones); the score is
its share when the sums are read as log likelihoods with equal priors.

Fitting reads a sample of the labelled rows: for each language the ``sample`` / languages rows with the smallest hash
of id and text, all of them up to that number; repeated rows count once. The words of their whole texts are counted by Spark,
n-grams from the distinct words with those counts, and the ``KEYS`` commonest words and n-grams of each length
are the model, so its size is bounded by 6 * ``KEYS`` * languages numbers. At most ``MAX_LANGUAGES`` languages. Scoring reads every whole
text once, without a shuffle.

Learnt are rows with a text and a language whose id's crc32 modulo 5 is not 0; language, source and id are no
inputs of a prediction. Defined cases: ``und`` with score 0 for a text that is null or has no letter, and for every text if
nothing could be learnt. A null doc_id is held in and not learnt. Rows that repeat an id each get a row; an empty table gives
none. Very long texts are read whole. Further input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import register
from tidemark.llm.textnp import Words, blocks, mix, salt

LONGEST = 5
SAMPLE = 40_000
KEYS = 50_000
MAX_LANGUAGES = 1000
SMOOTH = 0.5


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def letters_only(text: Column) -> Column:
    """Lower-cased words of letters and marks, one space between them."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")


def grams(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams in code points of words with a space before, between and after them, and the number of each
    one's word. A space stands first or last in a gram, never alone."""
    count = len(points) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = points == 32
    upto = np.r_[0, np.cumsum(space)]
    at = np.arange(count)
    inner = upto[at + max(1, n - 1)] - upto[at + 1] if n > 1 else space[at]
    at = at[(inner == 0) & ~(space[at] & space[at + n - 1])]
    h = np.full(len(at), salt(n))
    for j in range(n):
        h = mix(h + points[at + j].astype(np.uint64))
    return h, upto[at + 1] - 1


def spaced(words: Words, which: np.ndarray) -> np.ndarray:
    """Code points of some words with a space before, between and after them."""
    start, size = words.start[which], words.end[which] - words.start[which]
    at = np.cumsum(size + 1) - size  # place of each word behind its space
    out = np.full(int((size + 1).sum()) + 1, 32, np.uint8)
    own = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + own] = words.raw[np.repeat(start, size) + own]
    return np.frombuffer(out.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


class LanguageModel:
    """Languages, and for words (level 0) and n-grams (level n) sorted hashes with a row of log shares each."""

    def __init__(self, languages: list[str], levels: list[tuple[np.ndarray, np.ndarray]]):
        self.languages, self.levels = languages, levels

    def find(self, level: int, h: np.ndarray) -> np.ndarray:
        keys = self.levels[level][0]
        if not len(keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, at, -1)

    def sums(self, column) -> np.ndarray:
        """For each text (words with spaces between) and language the sum over its words."""
        words = Words(column)
        texts, langs = len(words.offsets) - 1, range(len(self.languages))
        out = np.zeros((texts, len(self.languages)))
        row = self.find(0, words.hash)
        known = row >= 0
        for k in langs:
            out[:, k] += np.bincount(words.text[known], self.levels[0][1][row[known], k], texts)
        left = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            h, of = grams(spaced(words, left), n)
            row = self.find(n, h)
            h, of, row = h[row >= 0], of[row >= 0], row[row >= 0]
            size = np.bincount(of, minlength=len(left))
            for k in langs:
                mean = np.bincount(of, self.levels[n][1][row, k], len(left)) / np.maximum(size, 1)
                out[:, k] += np.bincount(words.text[left], mean, texts)
            left = left[size == 0]
        return out


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang and text of at most about ``sample`` labelled rows."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.withColumn("h", F.xxhash64("doc_id", "text"))
    narrow = stored(known.select("lang", "h").distinct(), "labelled")
    languages = narrow.select("lang").distinct().count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; at most {MAX_LANGUAGES}")
    each = max(1, sample // max(1, languages))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    upto = narrow.withColumn("rank", rank).where(F.col("rank") <= each).groupBy("lang").agg(F.max("h").alias("upto"))
    # one row a language, at most MAX_LANGUAGES
    taken = known.join(F.broadcast(upto), "lang").where(F.col("h") <= F.col("upto"))
    return taken.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, sample: int = SAMPLE, keys: int = KEYS) -> LanguageModel:
    """Model of rows (doc_id, text, lang)."""
    words = stored(training_sample(docs, sample).select("lang", F.explode(F.split(letters_only(F.col("text")), " ")).alias("word"))
                   .where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")

    def run(batches):
        for b in blocks(batches, "word", 1 << 18):
            w = Words(b.column("word"))
            one = np.flatnonzero(w.counts == 1)  # every row, as a word has no space
            first = w.first[one]
            points, lang, n = spaced(w, first), b.column("lang").take(pa.array(one)), b.column("n").to_numpy()[one]
            for level in range(LONGEST + 1):
                h, of = (w.hash[first], np.arange(len(one))) if level == 0 else grams(points, level)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), level, np.int32)), pa.array(h.view(np.int64)), lang.take(pa.array(of)).cast(pa.string()),
                     pa.array(n[of], pa.int64())], names=["level", "h", "lang", "n"])

    counts = stored(words.select("lang", "word", "n").mapInArrow(run, "level int, h long, lang string, n long")
                    .groupBy("level", "h", "lang").agg(F.sum("n").alias("n")), "counts")
    totals = counts.groupBy("level", "lang").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in totals})
    total = {(r["level"], r["lang"]): r["n"] for r in totals}
    best = Window.partitionBy("level").orderBy(F.desc("total"), "h")
    top = counts.groupBy("level", "h").agg(F.sum("n").alias("total"))
    top = top.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keys).select("level", "h")
    rows = counts.join(top, ["level", "h"]).toArrow()  # at most 6 * keys * languages rows
    level, h = rows["level"].to_numpy(), rows["h"].to_numpy().view(np.uint64)
    lang = np.searchsorted(np.array(languages, object), rows["lang"].to_numpy().astype(object)) if languages else np.zeros(0, int)
    n, levels = rows["n"].to_numpy(), []
    for k in range(LONGEST + 1):
        of = level == k
        key, at = np.unique(h[of], return_inverse=True)
        table_ = np.full((len(key), len(languages)), SMOOTH)
        table_[at, lang[of]] += n[of]
        share = np.array([total.get((k, x), 0) for x in languages]) + SMOOTH * max(1, len(key))
        levels.append((key, np.log(table_ / share)))
    return LanguageModel(languages, levels)


def identify(docs: DataFrame, sample: int = SAMPLE, keys: int = KEYS, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, keys))

    def run(batches):
        m = model.value
        for b in blocks(batches):
            has = b.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            if not m.languages:
                has[:] = False
                name, score = np.full(len(has), "und", object), np.zeros(len(has))
            else:
                s = m.sums(b.column("text"))
                best = s.argmax(1)
                share = 1 / np.exp(s - s[np.arange(len(s)), best][:, None]).sum(1)
                name, score = np.where(has, np.array(m.languages, object)[best], "und"), np.where(has, share, 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(name, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    told = docs.select("doc_id", letters_only(F.col("text")).alias("text"), lettered.alias("lettered"))
    return (told.mapInArrow(run, "doc_id long, lang_pred string, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


@register("op11_word_backoff")
def op11_word_backoff(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
