"""Sources and sinks (A1-A15) on small inputs."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files, sinks

NATION = ["0|NORTHLAND|0|cold and wide", "1|EASTMARK|1|many rivers", "2|SOUTHPORT|1|by the sea"]


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_tbl_parts_natural_order_and_pruning(spark, tmpdir_path):
    # parts 1, 2 and 10: natural order puts .10 last
    for i, lines in [(1, NATION[:1]), (2, NATION[1:2]), (10, NATION[2:])]:
        _write(os.path.join(tmpdir_path, f"nation.tbl.{i}"), lines)
    assert [p.rsplit(".", 1)[-1] for p in files.table_files(tmpdir_path, "nation")] == ["1", "2", "10"]
    df = files.read_tbl_table(spark, tmpdir_path, "nation", columns=["n_name", "n_nationkey"], with_part=True)
    assert df.columns == ["n_nationkey", "n_name", "part_idx"]
    assert sorted((r.n_name, r.part_idx) for r in df.collect()) == [("EASTMARK", 1), ("NORTHLAND", 0), ("SOUTHPORT", 2)]


def test_trailing_delimiter_and_empty_is_null(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "region.tbl")
    _write(p, ["0|UPLAND|first|", "1||second|"])
    df = files.read_delimited(spark, p, files.TPCH_SCHEMAS["region"], trailing_delimiter=True)
    rows = sorted(df.collect())
    assert df.columns == ["r_regionkey", "r_name", "r_comment"]
    assert rows[1].r_name is None and rows[0].r_name == "UPLAND"


def test_bad_value_fails_fast(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "region.tbl")
    _write(p, ["x|UPLAND|c"])
    with pytest.raises(Exception):
        files.read_delimited(spark, p, files.TPCH_SCHEMAS["region"]).collect()


def test_header_csv_cast_and_sort_job(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "cap.csv")
    rows = [(1990 + 7 * k % 80, f"A{k * 37 % 50:03}") for k in range(25)] + [("no year", "B000")]
    _write(p, ["Year,SerialNumber", *[f"{y},{n}" for y, n in rows]])
    df = files.read_header_csv_cast(spark, p, {"Year": "int"})
    out = df.where(F.col("Year") <= 2023).orderBy(F.col("Year").desc(), F.col("SerialNumber").asc()).collect()
    want = sorted(((y, n) for y, n in rows[:-1] if y <= 2023), key=lambda r: (-r[0], r[1]))
    assert [(r.Year, r.SerialNumber) for r in out] == want
    dest = os.path.join(tmpdir_path, "out")
    sinks.write_single_csv(spark.createDataFrame(out), dest)
    parts = [f for f in os.listdir(dest) if f.endswith(".csv")]
    assert len(parts) == 1
    assert open(os.path.join(dest, parts[0])).readline().strip() == "Year,SerialNumber"


def test_text_lines_and_literal(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "fox.txt")
    _write(p, ["The quick brown fox jumps over the lazy dog"])
    assert files.read_lines(spark, p).first().value == "The quick brown fox jumps over the lazy dog"
    lit = files.literal_table(spark, [("hello", "my"), ("world", "name")], "col1 string, col2 string")
    assert lit.where(F.col("col2") == "my").count() == 1


def test_formatted_csv_and_layouts(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2.0 / 3.0), (2, 10.5)], "k int, v double")
    assert [r.v for r in sinks.format_floats(df).orderBy("k").collect()] == ["0.667", "10.500"]
    dest = os.path.join(tmpdir_path, "bounded")
    sinks.write_bounded(spark.range(100).toDF("k"), dest, 30)
    assert spark.read.parquet(dest).count() == 100
    assert len([f for f in os.listdir(dest) if f.endswith(".parquet")]) >= 4
    dest = os.path.join(tmpdir_path, "ranged")
    sinks.write_partitioned(spark.range(100).toDF("k"), dest, 4, "k")
    assert len([f for f in os.listdir(dest) if f.endswith(".parquet")]) == 4


def test_catalog_keys_and_counts():
    assert files.key_columns(files.TPCH_SCHEMAS["lineitem"]) == ["l_orderkey", "l_linenumber"]
    assert files.expected_rows("lineitem", 0.05) == 300_000 and files.expected_rows("nation", 0.05) == 25


def test_positional_and_rename(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    assert files.read_positional(df, [2, 0]).columns == ["x", "z"]
    assert files.rename_all(df, ["a", "b", "c"]).columns == ["a", "b", "c"]


def test_bucketed_tables_join_without_shuffle(spark):
    from conftest import SF001
    from tidemark.sources.tpch import tables
    t = tables(spark, SF001)
    sinks.write_bucketed(t["lineitem"].select("l_orderkey", "l_extendedprice"), "tm_li_b", 8, "l_orderkey")
    sinks.write_bucketed(t["orders"].select("o_orderkey", "o_orderpriority"), "tm_o_b", 8, "o_orderkey")
    li, o = spark.table("tm_li_b"), spark.table("tm_o_b")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s")))
    assert j.count() == t["lineitem"].select("l_orderkey").distinct().count()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_file_parts_natural_order(spark, tmpdir_path):
    from tidemark.operators.online import file_parts
    for i in (1, 2, 10):
        spark.range(i).toDF("x").coalesce(1).write.parquet(os.path.join(tmpdir_path, f"t.tbl.{i}"))
    import glob
    src = os.path.join(tmpdir_path, "flat")
    os.makedirs(src)
    for i in (1, 2, 10):
        f = glob.glob(os.path.join(tmpdir_path, f"t.tbl.{i}", "*.parquet"))[0]
        os.link(f, os.path.join(src, f"t.tbl.{i}.parquet"))
    df, n = file_parts(spark.read.parquet(src))
    assert n == 3
    got = sorted((r.part_idx, r["count"]) for r in df.groupBy("part_idx").count().collect())
    assert got == [(0, 1), (1, 2), (2, 10)]


def test_run_all(spark, tmpdir_path):
    from conftest import SF001
    out = sinks.run_all(spark, SF001, tmpdir_path, names=["tpch_q6", "course_a"])
    assert set(out) == {"tpch_q6", "course_a"}
    assert spark.read.parquet(out["tpch_q6"]).count() == 1


def test_register_tbl_tables(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "nation.tbl"), NATION)
    _write(os.path.join(tmpdir_path, "region.tbl"), ["0|AFRICA|x", "1|AMERICA|y"])
    names = files.register_tbl_tables(spark, tmpdir_path, suffix="_tbltest")
    assert sorted(names) == ["nation_tbltest", "region_tbltest"]
    r = spark.sql("SELECT r_name, count(*) AS n FROM nation_tbltest JOIN region_tbltest ON n_regionkey = r_regionkey "
                  "GROUP BY r_name ORDER BY r_name").collect()
    assert [(x.r_name, x.n) for x in r] == [("AFRICA", 1), ("AMERICA", 2)]


def test_parts_by_uri_in_folders_and_with_spaces(spark, tmpdir_path):
    from tidemark.operators.online import file_parts
    root = os.path.join(tmpdir_path, "with a space")
    for i, folder in enumerate(("day=1", "day=2")):  # the same base name twice
        os.makedirs(os.path.join(root, folder))
        _write(os.path.join(root, folder, "nation.tbl.1"), NATION[i:i + 1])
    _write(os.path.join(root, "day=2", "nation.tbl.10"), NATION[2:])
    for where in (root, f"file://{root}"):
        assert len(files.table_files(where, "nation")) == 3
        df = files.read_tbl_table(spark, where, "nation", columns=["n_name"], with_part=True)
        assert sorted((r.n_name, r.part_idx) for r in df.collect()) == [("EASTMARK", 1), ("NORTHLAND", 0), ("SOUTHPORT", 2)]
    lines, n = file_parts(spark.read.text(root))
    assert n == 3 and lines.select("part_idx").distinct().count() == 3
    with pytest.raises(FileNotFoundError):
        files.read_tbl_table(spark, root, "region")


def _files(path):
    out = []
    for d in sorted(x for x in os.listdir(path) if x.startswith("file=")):
        parts = [f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")]
        assert len(parts) == 1
        out.append(open(os.path.join(path, d, parts[0]), "rb").read())
    return out


@pytest.mark.parametrize("longest,bound", [(30, 200), (150, 200), (199, 200)])
def test_files_of_bounded_bytes(spark, tmpdir_path, longest, bound):
    """At most the bound, order kept, every line once; also with lines of more than half of it and of two-byte letters."""
    import random
    rnd = random.Random(longest)
    lines = ["é" * (rnd.randint(0, longest) // 2) + str(i % 10) * (rnd.random() < .3 and longest < 199) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(7)
    dest = os.path.join(tmpdir_path, "split")
    sinks.write_byte_bounded(df, dest, bound, order=["i"])
    got = _files(dest)
    assert max(map(len, got)) <= bound and b"".join(got).decode().split("\n")[:-1] == lines
    if longest == 30:
        assert len(got) <= 2 * sum(len(x.encode()) + 1 for x in lines) / bound


def test_a_line_over_the_bound(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b" * 500), (3, None), (4, "c")], "i int, value string")
    dest = os.path.join(tmpdir_path, "split")
    with pytest.raises(Exception, match="a line of more than 100 bytes"):
        sinks.write_byte_bounded(df, dest, 100, order=["i"])
    sinks.write_byte_bounded(df, dest, 100, order=["i"], oversize="alone")
    assert _files(dest) == [b"a\n", b"b" * 500 + b"\n", b"\nc\n"]


def _lines(folder, name, numbers):
    for i in numbers:
        _write(os.path.join(folder, f"{name}.tbl.{i}"), [f"{i}|SUPPLIER {i}|street {i}|{i % 25}||{i * 1.5}|é {i}|", f"{i + 100}|x||1|p|-0.25||"])


def test_file_parts_data_source(spark, tmpdir_path):
    """A2: one split a file, numbers in natural order, the same rows as the reader that joins an index of files."""
    root = os.path.join(tmpdir_path, "a folder")
    os.makedirs(os.path.join(root, "deeper"))
    _lines(root, "supplier", (1, 2, 10))
    _lines(os.path.join(root, "deeper"), "supplier", (3,))
    _lines(root, "customer", (1,))
    df = files.table_parts(spark, root, "supplier", trailing_delimiter=True)
    other = files.read_tbl_table(spark, root, "supplier", trailing_delimiter=True, with_part=True)
    assert df.columns == other.columns and df.rdd.getNumPartitions() == 4
    assert sorted(df.collect(), key=str) == sorted(other.collect(), key=str)
    assert files.table_parts(spark, f"file://{root.replace(' ', '%20')}", "supplier", trailing_delimiter=True).count() == 8
    for bad in ("x|two|three", "1|a|b|1"):
        _write(os.path.join(root, "region.tbl"), ["0|NORTH|c", bad])
        with pytest.raises(Exception, match="line 2"):
            files.table_parts(spark, root, "region").collect()
    with pytest.raises(Exception, match="no nation.tbl"):
        files.table_parts(spark, root, "nation").collect()


def test_file_parts_stream(spark, tmpdir_path):
    """Numbers in order, kept over a restart and for files that come later; batch and stream agree."""
    root, mark = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "checkpoint")
    os.makedirs(root)
    _lines(root, "supplier", (2, 10, 1))
    seen = {}

    def run():
        df = files.table_parts_stream(spark, root, "supplier", trailing_delimiter=True)
        keep = lambda b, i: seen.__setitem__(i, sorted((r.s_suppkey, r.part_idx) for r in b.collect()))
        q = df.writeStream.foreachBatch(keep).option("checkpointLocation", mark).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    run()
    assert seen == {0: [(1, 0), (2, 1), (10, 2), (101, 0), (102, 1), (110, 2)]}
    batch = files.table_parts(spark, root, "supplier", trailing_delimiter=True)
    assert sorted((r.s_suppkey, r.part_idx) for r in batch.collect()) == sorted(x for b in seen.values() for x in b)
    seen.clear()
    run()
    assert not any(seen.values())
    _lines(root, "supplier", (0, 5))  # before the others by name, after them by number
    run()
    assert sorted(x for b in seen.values() for x in b) == [(0, 3), (5, 4), (100, 3), (105, 4)]
