"""Total sort + validation (E4, E5), the sort job, and online sums with bounds."""

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators import sorting as S
from tidemark.operators.bounds import bucket_of, online_sum_ci
from tidemark.plans.joinsums import wj_exact_10, wj_exact_7, wj_online_skew_10, wj_online_skew_7
from tidemark.plans.jobs import job_terasort


def test_teragen_sort_validate(spark):
    recs = S.teragen(spark, 20000)
    assert recs.count() == 20000
    sizes = recs.select(F.octet_length("key").alias("k"), F.octet_length(F.concat(*recs.columns)).alias("n")).distinct().collect()
    assert [(r.k, r.n) for r in sizes] == [(10, 100)]
    srt = S.total_sort(recs, ["key"], 8)
    v = S.validate_sort(srt, "key").first()
    assert v.partitions_sorted and v.boundaries_ordered and v.rows == 20000
    assert v.checksum == S.checksum(recs, recs.columns).first().checksum


def test_validate_detects_disorder(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int").coalesce(1)
    assert not S.validate_sort(df, "k").first().partitions_sorted
    parts = spark.createDataFrame([(5,), (6,), (1,), (2,)], "k int").repartitionByRange(2, "k").sortWithinPartitions(
        F.col("k").desc())
    v = S.validate_sort(parts, "k", descending=[False]).first()
    assert not v.partitions_sorted


def test_multi_key_directions(spark):
    df = spark.createDataFrame([(2023, "a"), (2023, "b"), (2019, "a")], "y int, s string").coalesce(1)
    assert S.validate_sort(df, ["y", "s"], descending=[True, False]).first().partitions_sorted


def test_terasort_job(spark):
    r = job_terasort(spark, SF001).first()
    assert r.partitions_sorted and r.boundaries_ordered and r.checksum_match and r.rows == 60000


def test_bounds_final_step_is_exact(spark):
    for online, exact in [(wj_online_skew_7, wj_exact_7), (wj_online_skew_10, wj_exact_10)]:
        steps = online(spark, SF001).orderBy("step").collect()
        assert len(steps) == 50
        assert steps[0].half_width is None
        assert steps[-1].half_width == 0.0
        assert abs(steps[-1].estimate - exact(spark, SF001).first().revenue) < 0.02


def test_bucket_hash_spreads_and_is_stable(spark):
    df = spark.range(100000).select(bucket_of(F.col("id"), 50).alias("b"))
    counts = [r["count"] for r in df.groupBy("b").count().collect()]
    assert len(counts) == 50 and min(counts) > 1500
    big = spark.createDataFrame([(2 ** 62,)], "u long").select(bucket_of(F.col("u"), 50).alias("b")).first().b
    assert 0 <= big < 50


def test_interval_covers_truth_mostly(spark):
    """Coverage over many independent orderings (salts), not one run."""
    vals = spark.range(20000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("v"))
    truth = vals.agg(F.sum("v")).first()[0]
    hits = total = 0
    for salt in range(12):
        steps = online_sum_ci(vals, F.col("v"), F.col("id") * 7919 + salt * 104729, 50).where(
            F.col("step").between(10, 40)).collect()
        for s in steps:
            total += 1
            hits += abs(s.estimate - truth) <= s.half_width
    assert hits / total > 0.85


def test_validate_sorted_files_catches_disorder(spark, tmpdir_path):
    import os
    cols = ["key", "rowid", "filler"]
    recs = S.teragen(spark, 5000)
    good = os.path.join(tmpdir_path, "good")
    S.total_sort(recs, ["key"], 4).write.parquet(good)
    v = S.validate_sorted_files(spark, good, "key", cols).first()
    assert v.partitions_sorted and v.boundaries_ordered and v.rows == 5000
    assert v.checksum == S.checksum(recs, cols).first().checksum
    # ranges written in reverse file order: each file sorted, boundaries not
    rev = os.path.join(tmpdir_path, "rev")
    S.total_sort(recs.withColumn("neg", F.lit(0)), [F.col("key").desc()], 4) \
        .sortWithinPartitions("key").drop("neg").write.parquet(rev)
    v = S.validate_sorted_files(spark, rev, "key", cols).first()
    assert v.partitions_sorted and not v.boundaries_ordered
    # unsorted inside a file
    bad = os.path.join(tmpdir_path, "bad")
    recs.coalesce(1).write.parquet(bad)
    assert not S.validate_sorted_files(spark, bad, "key", cols).first().partitions_sorted


def test_max_buckets_caps_the_walk(spark):
    vals = spark.range(5000).select(F.col("id"), (F.col("id") % 13).cast("double").alias("v"))
    full = {r.step: r for r in online_sum_ci(vals, F.col("v"), F.col("id"), 40).collect()}
    capped = online_sum_ci(vals, F.col("v"), F.col("id"), 40, max_buckets=10).orderBy("step").collect()
    assert [r.step for r in capped] == list(range(1, 11))
    assert all((r.estimate, r.half_width) == (full[r.step].estimate, full[r.step].half_width) for r in capped)


def test_bucket_layout_prunes_unread_buckets(spark, tmpdir_path):
    import os
    from conftest import SF001
    from tidemark.operators.bounds import write_bucket_layout
    from tidemark.sources.tpch import tables
    li = tables(spark, SF001)["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount")
    path = os.path.join(tmpdir_path, "li_by_bucket")
    write_bucket_layout(li, F.col("l_orderkey"), path, 20)
    laid = spark.read.parquet(path)
    val = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    early = online_sum_ci(laid, val, buckets=20, max_buckets=5, bucket_col="bucket")
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket#" in plan
    full = {r.step: r for r in online_sum_ci(li, val, F.col("l_orderkey"), 20).collect()}
    got = early.orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3, 4, 5]
    assert all((r.estimate, r.half_width, r.rows_seen) == (full[r.step].estimate, full[r.step].half_width,
                                                           full[r.step].rows_seen) for r in got)


def test_record_keys_are_the_generators_states(spark):
    import numpy as np
    ids = [0, 1, 2, 3, 12345, 2 ** 33 + 7, 10 ** 13 + 1, 2 ** 62 + 11]
    for seed in (0, 5, (1 << 100) + 3):
        for n, key in zip(ids, S.record_keys(np.array(ids), seed)):
            state, x = seed, S.lcg_state(n, seed)
            if n < 20_000:
                for _ in range(n):
                    state = (state * S.LCG_MULT + S.LCG_ADD) % (1 << 128)
                assert state == x
            hi, lo, want = x >> 64, x & (1 << 64) - 1, ""
            for _ in range(9):
                want += chr(33 + hi % 94)
                hi //= 94
            assert key == want + chr(33 + (lo >> 32) % 94)


def test_records_do_not_depend_on_the_partitions(spark):
    ids = spark.range(3000).union(spark.createDataFrame([(10 ** 13 + 5,)], "id long"))
    a, b = (S.tera_records(ids.repartition(n)) for n in (1, 7))
    assert a.exceptAll(b).count() == 0 and a.count() == 3001
    assert a.where(F.col("rowid").endswith("9184E72A005")).count() == 1


def test_a_hot_key_covers_many_ranges(spark):
    """A third of the rows with one key (half of those the very same row): balanced partitions, order kept."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 1000).alias("k"),
                                      F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id")).alias("x"))
    out = S.total_sort(rows, ["k"], 12)
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 12 and sizes[-1] <= 2 * sizes[6]
    v = S.validate_sort(out, "k").first()
    assert v.partitions_sorted and v.boundaries_ordered and v.rows == 30_000 and v.checksum == S.checksum(rows, ["k", "x"]).first().checksum
    down = S.total_sort(rows, [F.col("k").desc()], 12)
    v = S.validate_sort(down, "k", descending=[True]).first()
    assert v.partitions_sorted and v.boundaries_ordered


def test_bounds_that_hold_when_stopping():
    """Cover of the true sum at the stop, over many orders of normal bucket totals; a fixed-step bound misses more."""
    import numpy as np
    from tidemark.operators.bounds import looks, quantiles, sequential_quantiles
    rng, buckets = np.random.default_rng(2), 50
    crit, fixed = sequential_quantiles(buckets, 0.95, 5), quantiles(buckets, 0.95)
    ever = [0, 0]
    for _ in range(2000):
        y = rng.normal(100, 30, buckets)
        for i, q in enumerate((crit, fixed)):
            for m in looks(buckets, 5)[:-1]:
                half = q[m - 1] * buckets * np.sqrt((1 - m / buckets) * y[:m].var(ddof=1) / m)
                if abs(buckets * y[:m].mean() - y.sum()) > half:
                    ever[i] += 1
                    break
    assert ever[0] / 2000 <= 0.05 < ever[1] / 2000


def test_sequential_sum_stops_and_reads_no_more(spark, tmpdir_path):
    import os
    from tidemark.operators.bounds import online_sum_sequential, read_until, write_bucket_layout
    vals = spark.range(40_000).select(F.col("id"), (F.col("id") % 97 + 1).cast("double").alias("v"))
    every = online_sum_sequential(vals, F.col("v"), F.col("id"), 40, report_every=4).orderBy("step").collect()
    assert [r.step for r in every] == list(range(4, 41, 4)) and [r.stop for r in every] == [False] * 9 + [True]
    got = online_sum_sequential(vals, F.col("v"), F.col("id"), 40, report_every=4, relative=0.05).orderBy("step").collect()
    assert len(got) < 10 and got[-1].half_width <= 0.05 * got[-1].estimate and all(r.half_width > 0.05 * r.estimate for r in got[:-1])
    path = os.path.join(tmpdir_path, "laid")
    write_bucket_layout(vals, F.col("id"), path, 40)
    read = read_until(spark, path, F.col("v"), 40, 0.05, report_every=4)
    assert [(r["step"], r["rows_seen"], r["estimate"], r["half_width"], r["stop"]) for r in read] == [
        (r.step, r.rows_seen, r.estimate, r.half_width, r.stop) for r in got]
    assert read[-1]["rows_seen"] < 40_000
