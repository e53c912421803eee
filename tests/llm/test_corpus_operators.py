"""Corpus operators against brute force on small tables with nulls, empties, ties and clashing names."""

import hashlib
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tidemark.llm.registry")
import public_tokenizers as P  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import (bpe, embedding_dedup, exact_dedup, jaccard_join, packing, quality, repair,  # noqa: E402
                          sharding, substring_dedup, url_filter)

WORDS = [f"w{i}" for i in range(400)]
RNG = np.random.default_rng(4)


def _texts():
    prose = lambda n: " ".join(RNG.choice(WORDS, n))
    base, passage = prose(120), prose(30)
    near = base.split()
    near[50] = "changed"
    long = prose(20_000)
    return [base, base.replace(" ", "\t"), " ".join(near), prose(40) + " " + passage + " " + prose(30),
            prose(25) + " " + passage, None, "", " \n\t ", "one", "ONE", "one two", "a " * 60, "a " * 20, long,
            "été <|endoftext|> naïve!! it's 漢字\u00a0x", prose(80), base]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, h string, norm string, chunk int, root string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_exact_dedup(docs, nothing):
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs).collect()}
    for i, t in enumerate(TEXTS):
        same = [j for j, u in enumerate(TEXTS) if _norm(u) == _norm(t)]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (same[0], len(same), same[0] == i)
        assert r["text_sha256"] == hashlib.sha256(_norm(t).encode()).hexdigest()
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_dedup_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    got = sorted(map(tuple, exact_dedup.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == sorted([(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (None, None, 1, True)], key=str)


def test_substring_dedup_brute_force(docs, nothing):
    for k in (3, 13, 20):
        seen = {}
        for i, t in enumerate(TEXTS):
            w = _words(t)
            for p in range(len(w) - k + 1):
                seen.setdefault(tuple(w[p:p + k]), set()).add(i)
        for r in substring_dedup.substring_dedup(docs, k=k, chunk_bytes=40_000, bucket_bytes=50_000).collect():
            w = _words(TEXTS[r["doc_id"]])
            gone = set()
            for p in range(len(w) - k + 1):
                if min(seen[tuple(w[p:p + k])]) < r["doc_id"]:
                    gone |= set(range(p, p + k))
            assert (r["n_words"], r["n_removed"]) == (len(w), len(gone))
            assert r["kept"] == " ".join(x for p, x in enumerate(w) if p not in gone)
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_jaccard_components_brute_force(docs, nothing):
    for n, num in ((3, 90), (5, 80)):
        sets = []
        for t in TEXTS:
            w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in _words(t)]
            sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
        root = list(range(len(sets)))
        for _ in sets:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if a and b and 100 * len(a & b) >= num * len(a | b):
                        root[i] = root[j] = min(root[i], root[j])
        for block in (2000, 2):
            got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
                   for r in jaccard_join.jaccard_components(docs, n, num, block=block).collect()}
            assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert jaccard_join.jaccard_components(nothing).count() == 0


def test_trie_links_brute_force():
    for trial in range(60):
        num, den = [(90, 100), (1, 2), (1, 1)][trial % 3]
        base = [np.unique(RNG.integers(0, 40, 25)) for _ in range(2)]
        sets = [np.unique(np.r_[RNG.permutation(base[i % 2])[RNG.integers(0, 3):], RNG.integers(0, 45, 1)]).astype(np.uint64)
                for i in range(12)]
        links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
                 if i < j and den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))}
        got = jaccard_join.trie_links(sets, num, den)
        assert {(min(p), max(p)) for p in got} <= links
        assert _roots(12, got) == _roots(12, links)


def _roots(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def _component_ids(near):
    """Smallest index that each row reaches."""
    root = np.arange(len(near))
    while True:
        new = np.where(near, root[None, :], len(near)).min(1)
        new = np.minimum(new, root)
        if (new == root).all():
            return root
        root = new


@pytest.mark.parametrize("window", [2000, 16])  # one block; many
def test_embedding_links(spark, window):
    centre = RNG.standard_normal((20, 16))
    rows = [(i, [float(x) for x in centre[i % 20] + 0.03 * RNG.standard_normal(16)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (304, []), (305, [1.0]), ((1 << 63) - 1, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit("x")).withColumn("run", F.lit(1))
    x = np.array([v for i, v in rows if i < 300])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    root = _component_ids(near)
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df, block=16, window=window).collect()}
    assert len(got) == len(rows)
    for i in range(230):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum() - 1, root[i], root[i] == i)
    for i in [*range(300, 306), (1 << 63) - 1]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert embedding_dedup.near_vectors(df.where("false")).count() == 0


def test_embedding_null_and_repeated_ids_and_ties(spark):
    tie = [0.95, float(np.sqrt(1 - 0.95 ** 2))]
    rows = [(7, [1.0, 0.0]), (7, [2.0, 0.0]), (None, [3.0, 0.0]), (None, [0.0, -1.0]), (8, [-1.0, 0.0]), (9, tie)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(embedding_dedup.near_vectors(df).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["n_links"]))
    near = int(np.dot(tie, [1.0, 0.0]) / np.linalg.norm(tie) >= 0.95)
    seven = 2 + near
    assert [tuple(r) for r in got] == [(7, seven, 7, True), (7, seven, 7, True), (8, 0, 8, True), (9, 3 * near, 7 if near else 9, not near),
                                       (None, 0, None, True), (None, seven, 7, False)]


def _model(name):
    return Tokenizer.from_file(P.path(name))


def test_bpe_round_trip(docs):
    path, tok = P.path("byte_bpe_50k.json"), _model("byte_bpe_50k.json")
    for r in bpe.bpe_decode(bpe.bpe_encode(docs, path), path).collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == tok.encode(text, add_special_tokens=False).ids
        assert r["text"] == tok.decode(r["ids"], skip_special_tokens=False)


def test_packing(docs, nothing):
    rows = packing.pieces(docs, P.path("word_bpe_49k.json"), with_ids=True).collect()
    tok = _model("word_bpe_49k.json")
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(TEXTS)}
    for i, ids in want.items():
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == ids
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)
    placed = packing.pack(packing.pieces(docs, P.path("word_bpe_49k.json"))).collect()
    _gapless([(r["sequence_id"], r["offset"], r["length"]) for r in placed], 4096)
    assert packing.pack(packing.pieces(nothing, P.path("word_bpe_49k.json"))).count() == 0


def _gapless(rows, capacity):
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity


def test_packing_plan():
    for _ in range(100):
        counts = {int(n): int(RNG.integers(1, 5)) for n in RNG.integers(1, 51, RNG.integers(1, 30))}
        runs, used = packing.plan(counts, 50)
        rows = [(f + k // e, o + k % e * n, n) for n, m, f, e, o in runs for k in range(m)]
        _gapless(rows, 50)
        assert len({s for s, _, _ in rows}) == used
        have = {}
        for _, _, n in rows:
            have[n] = have.get(n, 0) + 1
        assert have == counts


def test_repair_files(spark, docs, tmp_path):
    out, tok = str(tmp_path / "ids"), _model("byte_bpe_50k.json")
    repair.write_ids(docs, out, P.path("byte_bpe_50k.json"), shard_ids=500)
    start = 0
    for r in sorted(repair.read_ids(spark, out).collect(), key=lambda r: r["doc_id"]):
        ids = tok.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids + [0]
        assert (r["start"], r["ids"]) == (start, ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    row = max(spark.read.parquet(out).collect(), key=lambda r: r["ids"])
    full = repair.read_range(row, 0, row["ids"])
    assert (repair.read_range(row, 100, 300) == full[100:300]).all()


def test_sharding(docs, nothing):
    rows = sharding.assign_shards(docs, 5, rows_per_bucket=2).collect()
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    for r in rows:
        raw = (TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 5)
    keys = RNG.integers(0, 2**63, 20_000).astype(np.uint64)
    a, b = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert ((a == b) | (b == 40)).all() and 300 < (a != b).sum() < 700 and np.bincount(a, minlength=40).min() > 400
    assert sharding.assign_shards(nothing, 5).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no-scheme", "http://A.spam.example.com/x?y#z", "https://notspam.example.com", "x://spam.example.com",
            "http://m.example.org/es/1", "http://example.org/en/12#a", "http://b.org", "http://a.com/fr/", "http://a.com/de/?"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit(1))
    listed = spark.createDataFrame([("spam.example.com",), (None,)], "key string")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages, listed, url_filter.RULES).collect()}
    assert [got[i]["verdict"] for i in range(11)] == ["allow"] * 3 + ["block", "allow", "block", "block", "block", "allow", "allow", "block"]
    assert (got[3]["host"], got[3]["path"], got[3]["rule"]) == ("a.spam.example.com", "/x", None)
    assert [got[i]["rule"] for i in (6, 7, 8, 9)] == ["example.org/es/", "example.org/en/1", None, "com/fr/"]
    assert url_filter.url_filter(pages.where("false"), listed.where("false")).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.BloomCascade(universe)
    assert len(cascade.levels) > 1
    assert universe.where(cascade.listed(F.col("key")) != F.col("listed")).count() == 0
    with pytest.raises(ValueError):
        url_filter.BloomCascade(universe, max_bits=64)


def test_quality(spark, docs, nothing):
    SF001 = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    rows = quality.quality_scores(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality_scores(nothing, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(docs, labels.where("false")).collect()} == {0.5}


def test_pipeline(spark):
    import corpus_pipeline
    SF001 = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = corpus_pipeline.exact(spark, docs, SF001)
    rows = docs.collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(_norm(r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values()) and kept.columns == docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF001).columns == docs.columns
    out = corpus_pipeline.run(spark, SF001)
    _gapless([(r["sequence_id"], r["offset"], r["length"]) for r in out.collect()], 4096)


def _dense(n, dim, planted, rng):
    """A third of the rows in one cluster of mutual cosine 0.85, ``planted`` pairs at 0.957 inside it, the rest spread."""
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    centre = unit(rng.standard_normal((1, dim)))
    off = rng.standard_normal((n // 3, dim))
    off = unit(off - off @ centre.T * centre)
    turn = rng.standard_normal((planted, dim))
    turn -= turn @ centre.T * centre
    turn = unit(turn - (turn * off[:planted]).sum(1, keepdims=True) * off[:planted])
    cos = (0.957 - 0.85) / 0.15
    off[planted:2 * planted] = cos * off[:planted] + np.sqrt(1 - cos * cos) * turn
    return np.r_[np.sqrt(0.85) * centre + np.sqrt(0.15) * off, unit(rng.standard_normal((n - n // 3, dim)))]


@pytest.mark.parametrize("n, window", [(3_000, 150), (12_000, 400)])
def test_embedding_dense_cluster(spark, tmp_path, n, window):
    import pyarrow as pa
    import pyarrow.parquet as pq
    x = _dense(n, 64, 300, np.random.default_rng(11))
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)}), tmp_path / "v.parquet")
    near = x @ x.T >= 0.95
    links, root = near.sum(1) - 1, _component_ids(near)
    got = embedding_dedup.near_vectors(spark.read.parquet(str(tmp_path / "v.parquet")), window=window).toPandas().sort_values("vec_id")
    assert (got["n_links"].to_numpy() <= links).all()
    assert got["n_links"].sum() >= 0.97 * links.sum() >= 0.97 * 600
    assert (got["component_id"].to_numpy() == root).mean() >= 0.99


def test_embedding_keys_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    x = embedding_dedup._unit([v.tobytes() for v in rng.standard_normal((97, 24))], 24)
    whole = embedding_dedup._hashes(x, 1, 0, 7)
    assert (whole == np.concatenate([embedding_dedup._hashes(x[i:i + 1], 1, 0, 7) for i in range(97)])).all()


def test_embedding_lone_neighbour_of_a_tight_cluster(spark):
    """A vector linked to every member of a cluster that fills the table far beyond a window."""
    rng = np.random.default_rng(5)
    line = np.zeros(12)
    line[0] = 1
    rows = [(i, [float(v) for v in line + 1e-4 * rng.standard_normal(12)]) for i in range(1200)]
    side = 0.96 * line
    side[1] = np.sqrt(1 - 0.96 ** 2)
    df = spark.createDataFrame(rows + [(5000, [float(v) for v in side])], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_vectors(df, window=60).where("vec_id in (3, 5000)").orderBy("vec_id").collect()
    assert [tuple(r) for r in got] == [(3, 1200, 0, False), (5000, 1200, 0, False)]


def test_embedding_many_lengths_of_one_direction(spark):
    line = RNG.standard_normal(8)
    df = spark.createDataFrame([(i, [float(v) for v in line * (1 + i / 7)]) for i in range(1500)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_vectors(df, block=8, window=8).select("n_links", "component_id").distinct().collect()
    assert [tuple(r) for r in got] == [(1499, 0)]


def _often(symbols):
    return max(np.unique(symbols[:-1] << 32 | symbols[1:], return_counts=True)[1], default=0)


def test_repair_goes_on_until_no_pair_is_frequent():
    ids = np.tile(RNG.permutation(1001), 500)
    for own in (ids, RNG.zipf(1.3, 20_000) % 300, ids[:1], ids[:0]):
        symbols, rules, lengths, base = repair.compress(own)
        assert (repair.expand(symbols, rules, lengths, base) == own).all()
        apart = symbols[np.r_[True, symbols[1:] != symbols[:-1]]] if len(symbols) else symbols
        assert _often(apart) < 16 + (len(symbols) - len(apart))
    assert len(repair.compress(ids)[0]) < 1000


def test_repair_takes_runs():
    for own in (np.full(100_001, 7), np.repeat(RNG.integers(0, 3, 3000), RNG.integers(1, 9, 3000)), np.tile([5, 5, 5, 6], 400)):
        symbols, rules, lengths, base = repair.compress(own)
        assert (repair.expand(symbols, rules, lengths, base) == own).all()
        assert len(symbols) < len(own) / 4
        assert _often(symbols) < 2 * 16 + 1  # overlapping places of a run count twice here at most
    assert len(repair.compress(np.full(100_001, 7))[0]) < 32


def test_repair_looks_again_only_where_pairs_may_be_frequent(monkeypatch):
    looked, cell = [], repair._cell
    monkeypatch.setattr(repair, "_cell", lambda pair: (looked.append(len(pair)), cell(pair))[1])
    ids = np.random.default_rng(5).zipf(1.2, 200_000).clip(0, 50_000).astype(np.int32)
    symbols, rules, lengths, base = repair.compress(ids)
    assert (repair.expand(symbols, rules, lengths, base) == ids).all()
    for lo in (len(symbols) // 2, len(symbols) - 20, len(symbols)):  # many symbols, few, none
        own = repair.expand(symbols[lo:], rules, lengths, base)
        assert (own == ids[len(ids) - len(own):]).all()
    pair = symbols[:-1] << 32 | symbols[1:]
    assert np.unique(pair[symbols[:-1] != symbols[1:]], return_counts=True)[1].max() < 16
    assert sum(looked) < 4 * len(ids)
