"""Each stage of the pipeline, and all of them, against brute force on rows with nulls, repeats and planted copies."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from test_corpus_operators import _gapless, _model, _norm, _words

import corpus_pipeline as cp
from tidemark.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, n_chars long, _row int, _id string"
BIG = 1 << 63


def _planted():
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(400)])
    prose = lambda n: " ".join(rng.choice(words, n))
    base, passage, lone = prose(200), prose(60), prose(90)
    near = base.split()
    near[100] = "other"
    texts = [(1, base), (2, base.replace(" ", "\n")), (3, " ".join(near)), (4, prose(30) + " " + passage + " " + prose(30)),
             (5, passage + "  " + prose(50)), (None, passage + " " + prose(20)), (None, base), (None, lone), (6, lone), (6, lone),
             (6, lone.replace(" ", "  ")), (6, prose(40)), (7, None), (8, ""), (None, None), (9, " "), (10, prose(3)), (None, prose(30)),
             (11, "€ " + prose(20)), (12, passage), (1, prose(70)), (None, " ".join(near))]
    return [(i, t, "en", len(t or ""), 7, "x") for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_planted(), COLUMNS)


def _rank(i):
    return BIG if i is None else i


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def brute_quality(spark, rows):
    """By the scores of the operator, row by row: texts alone decide."""
    d = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], COLUMNS)
    got = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(d, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    return [r for k, r in enumerate(rows) if got[k]]


def brute_exact(rows):
    best = {}
    for r in rows:
        key = (_rank(r[0]), __import__("hashlib").md5((r[1] or "").encode()).digest())
        if _norm(r[1]) not in best or key < best[_norm(r[1])][0]:
            best[_norm(r[1])] = (key, r)
    return [r for _, r in best.values()]


def brute_near(rows):
    def shingles(t):
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in _words(t)]
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for r, k in zip(rows, root):
        least[k] = min(least.get(k, BIG), _rank(r[0]))
    return [r for r, k in zip(rows, root) if _rank(r[0]) == least[k]]


def brute_substring(rows):
    first = {}
    for r in rows:
        w = _words(r[1])
        for i in range(len(w) - 49):
            first[tuple(w[i:i + 50])] = min(first.get(tuple(w[i:i + 50]), BIG), _rank(r[0]))
    out = []
    for r in rows:
        w, gone = _words(r[1]), set()
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < _rank(r[0]):
                gone |= set(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        if not gone:
            out.append(r)
        elif kept:
            out.append((r[0], kept, r[2], len(kept), *r[4:]))
    return out


def test_stages(spark, docs):
    rows = _planted()
    for stage, brute in ((cp.exact, brute_exact), (cp.near, brute_near), (cp.substring, brute_substring)):
        want = brute(rows)
        assert 0 < len(want) and (brute is brute_substring or len(want) < len(rows))
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert _sorted(got.collect()) == _sorted(want), stage


def test_quality_by_row(spark, docs, monkeypatch):
    """Rows of one id, or of none, go or stay by their own texts."""
    real = quality.quality_scores
    odd = lambda d, labels, **k: real(d, labels, **k).withColumn("predicted", (cp.F.crc32(cp.F.col("_row")) % 2).cast("int"))
    monkeypatch.setattr(cp, "quality_scores", odd)
    md5 = lambda t: __import__("hashlib").md5((t or "").encode()).digest()
    want = [r for r in _planted() if zlib.crc32(md5(r[1])) % 2]
    assert {r[0] for r in want} & {r[0] for r in _planted() if r not in want}
    assert _sorted(cp.quality(spark, docs, SF).collect()) == _sorted(want)


def test_run(spark, tmp_path, monkeypatch):
    """All stages in turn, the classifier's curve in place of fitted labels (none: 0.5, so all would go)."""
    rows = _planted()
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0 and brute_quality(spark, rows) == []
    real = quality.quality_scores
    monkeypatch.setattr(cp, "quality_scores", lambda d, labels, **k: real(d, labels, threshold=0.5, **k))
    want = brute_substring(brute_near(brute_exact(rows)))
    got = cp.run(spark, str(tmp_path)).collect()
    tok, pieces = _model("word_bpe_49k.json"), []
    for r in want:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [1]
        pieces += [(r[0], k, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes()))
                   for k, at in enumerate(range(0, len(ids), 4096))]
    assert _sorted(tuple(r)[:5] for r in got) == _sorted(pieces)
    _gapless([(r["sequence_id"], r["offset"], r["length"]) for r in got], 4096)
