"""Sinks and layouts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """One CSV file with a header, replacing what was there. Only for
    small final results: ``coalesce(1)`` funnels everything into one task."""
    df.coalesce(1).write.option("header", str(header).lower()).mode("overwrite").csv(path)


def format_floats(df: DataFrame, fmt: str = "%.3f") -> DataFrame:
    """double/float columns as fixed-format text (e.g. ``%.3f``)."""
    return df.select(*[F.format_string(fmt, F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_formatted_csv(df: DataFrame, path: str, fmt: str = "%.3f") -> None:
    """CSV with fixed float format, header, no index."""
    format_floats(df, fmt).write.option("header", "true").mode("overwrite").csv(path)


def write_partitioned(df: DataFrame, path: str, n: int, key: str, fmt: str = "parquet") -> None:
    """Split a table in ``n`` chunk files by ranges of ``key`` (one file
    per range partition)."""
    df.repartitionByRange(n, key).write.mode("overwrite").format(fmt).save(path)


def write_bounded(df: DataFrame, path: str, max_records: int, fmt: str = "parquet") -> None:
    """Size-bounded files: at most ``max_records`` rows per file. The
    read side bounds splits with ``spark.sql.files.maxPartitionBytes``."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).format(fmt).save(path)


def byte_bounded_files(lines: DataFrame, bound: int, text: str = "value", order: list[str] | None = None,
                       oversize: str = "error") -> DataFrame:
    """Number of the file (``file``) and place in it (``pos``) of each line, so that no file has more than ``bound``
    bytes, line ends included, and lines keep their order (``order``, or that of the input) over files and in them.

    Bytes before a line are a prefix sum over all tasks: sums of partitions, then running sums inside each. A file takes
    the lines that begin in one window of the sum; windows are narrower than the bound by the longest ordinary line, and a line
    longer than half of the bound gets a file of its own, so files are at least about half full elsewhere. A line over the
    bound fails the job, or with ``oversize="alone"`` is the one line of its file. The numbered lines are checkpointed."""
    from tidemark.session import checkpoint_dir
    if oversize not in ("error", "alone"):
        raise ValueError("oversize is 'error' or 'alone'")
    checkpoint_dir(lines.sparkSession)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    if oversize == "error":
        size = F.when(size > bound, F.raise_error(F.concat(F.lit(f"a line of more than {bound} bytes: "), size.cast("string")))).otherwise(size)
    ordered = lines.orderBy(*order) if order else lines
    d = ordered.withColumns({"pos": F.monotonically_increasing_id(), "__size": size}).checkpoint()
    d = d.withColumn("__part", F.shiftright("pos", 33))  # the id's high bits are the partition
    d = d.withColumn("__long", F.col("__size") * 2 > bound)
    short = F.when(~F.col("__long"), F.col("__size")).otherwise(0)
    own = Window.partitionBy("__part").orderBy("pos")
    parts = d.groupBy("__part").agg(F.sum(short).alias("bytes"), F.sum(F.col("__long").cast("long")).alias("longs"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = parts.select("__part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"__{c}") for c in ("bytes", "longs")])
    widest = F.lit(bound) - F.greatest(F.lit(0), d.agg(F.max(short)).scalar()) + 1
    so_far = own.rowsBetween(Window.unboundedPreceding, -1)
    began = F.col("__bytes") + F.coalesce(F.sum(short).over(so_far), F.lit(0))
    longs = F.col("__longs") + F.coalesce(F.sum(F.col("__long").cast("long")).over(so_far), F.lit(0))
    # files in order: lines after each long line begin a new one; (long lines before, window) tells ordinary ones apart
    d = (d.join(F.broadcast(offsets), "__part").withColumns({"__longs": longs, "__window": F.floor(began / widest)})
         .withColumn("file", F.concat(F.lpad(F.col("__longs").cast("string"), 12, "0"), F.lit("-"),
                                      F.when(F.col("__long"), F.lit("x")).otherwise(F.lpad(F.col("__window").cast("string"), 12, "0")))))
    return d.select(*[c for c in lines.columns], "file", "pos")


def write_byte_bounded(lines: DataFrame, path: str, bound: int, text: str = "value", order: list[str] | None = None,
                       oversize: str = "error") -> None:
    """Text files ``path/file=<number>/part-*`` of at most ``bound`` bytes each, in order (see :func:`byte_bounded_files`)."""
    d = byte_bounded_files(lines, bound, text, order, oversize)
    (d.repartition("file").sortWithinPartitions("file", "pos").select(F.coalesce(F.col(text), F.lit("")).alias(text), "file")
     .write.mode("overwrite").partitionBy("file").text(path))


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str, sort: bool = True) -> None:
    """A14 for repeated joins: a catalog table hash-bucketed (and sorted) on
    ``key``. Two tables bucketed the same way on their join keys join
    without a shuffle of either side, and aggregates on the key need none."""
    w = df.write.mode("overwrite").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)


def run_all(spark: SparkSession, sf_dir: str, out_dir: str, names: list[str] | None = None,
            fmt: str = "parquet") -> dict[str, str]:
    """Run registered queries, each result written to ``out_dir/<name>``."""
    from tidemark.plans import registry
    registry.load_all()
    written = {}
    for name, fn in registry.QUERIES.items():
        if names and name not in names:
            continue
        dest = os.path.join(out_dir, name)
        fn(spark, sf_dir).write.mode("overwrite").format(fmt).save(dest)
        written[name] = dest
    return written
