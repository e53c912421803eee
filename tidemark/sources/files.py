"""Delimited, text and literal sources; the TPC-H ``.tbl`` catalog.

Schemas are always explicit (no inference). Column pruning comes from
``select`` after the read, which Spark pushes into the CSV/parquet scan.
"""

from __future__ import annotations

import datetime
import io
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def _f(name, dtype, key=False):
    return T.StructField(name, dtype, True, metadata={"key": True} if key else {})


S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# A3: the TPC-H catalog as the reference declares it; key columns flagged in
# field metadata (used as defaults for forecasting keys).
TPCH_SCHEMAS: dict[str, T.StructType] = {
    "lineitem": T.StructType([
        _f("l_orderkey", L, True), _f("l_partkey", L), _f("l_suppkey", L), _f("l_linenumber", I, True),
        _f("l_quantity", D), _f("l_extendedprice", D), _f("l_discount", D), _f("l_tax", D),
        _f("l_returnflag", S), _f("l_linestatus", S), _f("l_shipdate", DT), _f("l_commitdate", DT),
        _f("l_receiptdate", DT), _f("l_shipinstruct", S), _f("l_shipmode", S), _f("l_comment", S)]),
    "orders": T.StructType([
        _f("o_orderkey", L, True), _f("o_custkey", L), _f("o_orderstatus", S), _f("o_totalprice", D),
        _f("o_orderdate", DT), _f("o_orderpriority", S), _f("o_clerk", S), _f("o_shippriority", I),
        _f("o_comment", S)]),
    "customer": T.StructType([
        _f("c_custkey", L, True), _f("c_name", S), _f("c_address", S), _f("c_nationkey", I), _f("c_phone", S),
        _f("c_acctbal", D), _f("c_mktsegment", S), _f("c_comment", S)]),
    "supplier": T.StructType([
        _f("s_suppkey", L, True), _f("s_name", S), _f("s_address", S), _f("s_nationkey", I), _f("s_phone", S),
        _f("s_acctbal", D), _f("s_comment", S)]),
    "nation": T.StructType([
        _f("n_nationkey", I, True), _f("n_name", S), _f("n_regionkey", I), _f("n_comment", S)]),
    "region": T.StructType([_f("r_regionkey", I, True), _f("r_name", S), _f("r_comment", S)]),
    "part": T.StructType([
        _f("p_partkey", L, True), _f("p_name", S), _f("p_mfgr", S), _f("p_brand", S), _f("p_type", S),
        _f("p_size", I), _f("p_container", S), _f("p_retailprice", D), _f("p_comment", S)]),
    "partsupp": T.StructType([
        _f("ps_partkey", L, True), _f("ps_suppkey", L, True), _f("ps_availqty", I), _f("ps_supplycost", D),
        _f("ps_comment", S)]),
}

# Rows per table at scale factor 1 (TPC-H specification).
ROWS_AT_SF1 = {"lineitem": 6_000_000, "orders": 1_500_000, "partsupp": 800_000, "part": 200_000,
               "customer": 150_000, "supplier": 10_000, "nation": 25, "region": 5}


def expected_rows(table: str, scale: float) -> int:
    if table in ("nation", "region"):
        return ROWS_AT_SF1[table]
    return int(ROWS_AT_SF1.get(table, 0) * scale)


def key_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("key")]


def read_delimited(spark: SparkSession, paths, schema: T.StructType, sep: str = "|", header: bool = False,
                   columns: list[str] | None = None, trailing_delimiter: bool = False,
                   mode: str = "FAILFAST", **options: str) -> DataFrame:
    """Delimited text with a declared schema. Empty fields are
    null (H12); a malformed value fails the read (``FAILFAST``). Rows that
    end in the delimiter get a dummy last column which is dropped. Further
    options go to Spark's reader."""
    if trailing_delimiter:
        schema = T.StructType(schema.fields + [T.StructField("_dummy", T.StringType(), True)])
    df = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
          .option("nullValue", "").option("emptyValue", "").option("mode", mode)
          .option("dateFormat", "yyyy-MM-dd").options(**options).csv(paths))
    if trailing_delimiter:
        df = df.drop("_dummy")
    if columns is not None:
        df = df.select(*columns)
    return df


def read_positional(df: DataFrame, idx: list[int]) -> DataFrame:
    """Keep columns by position (sorted, schema order)."""
    return df.select(*[df.columns[i] for i in sorted(idx)])


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    """B4."""
    return df.toDF(*names)


def natural_key(s: str):
    return [int(t) if t.isdigit() else t for t in re.split(r"(\d+)", s)]


BROADCAST_FILES = 200_000  # a file index of more rows is left to Spark's own choice of join


def _lookup(table: str) -> dict[str, str]:
    """Reader options for ``{table}.tbl*`` anywhere below a folder, on any file system."""
    return {"recursiveFileLookup": "true", "pathGlobFilter": f"{table}.tbl*"}


def table_files(directory: str, table: str) -> list[str]:
    """A2: ``{table}.tbl*`` below ``directory`` in natural order, as Spark's own file listing names them."""
    spark = SparkSession.active()
    return sorted(map(unquote, spark.read.options(**_lookup(table)).text(directory).inputFiles()), key=natural_key)


def with_file_part(df: DataFrame, part_name: str = "part_idx") -> tuple[DataFrame, int]:
    """``df`` with the rank of each row's input file in natural order of the whole path, and the number of
    files. The ranks are a table of one row per file (Spark holds that listing already), sent to the tasks
    while it has at most ``BROADCAST_FILES`` rows."""
    # without a host the listing writes scheme:///path, the rows' metadata scheme:/path
    files = sorted((re.sub("^([^:/]+):///", r"\1:/", f) for f in df.inputFiles()), key=lambda f: natural_key(unquote(f)))
    index = df.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], f"__file string, {part_name} long")
    if len(files) <= BROADCAST_FILES:
        index = F.broadcast(index)
    return df.withColumn("__file", F.col("_metadata.file_path")).join(index, "__file").drop("__file"), len(files)


def read_tbl_table(spark: SparkSession, directory: str, table: str, columns: list[str] | None = None,
                   trailing_delimiter: bool = False, with_part: bool = False) -> DataFrame:
    """A2/A3: a TPC-H table from its ``.tbl`` files: typed, pruned to
    ``columns`` (schema order), optionally tagged with the file's part index."""
    if not table_files(directory, table):
        raise FileNotFoundError(f"no {table}.tbl* under {directory}")
    schema = TPCH_SCHEMAS[table]
    df = read_delimited(spark, directory, schema, "|", False, trailing_delimiter=trailing_delimiter, **_lookup(table))
    if columns is not None:
        df = df.select(*[f.name for f in schema.fields if f.name in set(columns)])
    return with_file_part(df)[0] if with_part else df


def register_tbl_tables(spark: SparkSession, directory: str, trailing_delimiter: bool = False,
                        suffix: str = "") -> list[str]:
    """Every TPC-H ``.tbl`` table found under ``directory`` as a temp
    view (typed, one view per table)."""
    names = []
    for table in TPCH_SCHEMAS:
        if table_files(directory, table):
            read_tbl_table(spark, directory, table, trailing_delimiter=trailing_delimiter) \
                .createOrReplaceTempView(table + suffix)
            names.append(table + suffix)
    return names


def read_header_csv_cast(spark: SparkSession, path: str, casts: dict[str, str]) -> DataFrame:
    """A5: header CSV read as text, named columns cast with ``try_cast``
    (a bad value becomes null rather than failing the job)."""
    df = spark.read.option("header", "true").csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line (column ``value``)."""
    return spark.read.text(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """An in-memory table (tests and tiny lookups only)."""
    return spark.createDataFrame(rows, schema)


class TablePartsSource(DataSource):
    """A2 as a data source ``table_parts``: the rows of ``{table}.tbl*`` with the number of their part, in batch and
    stream. Options: ``path``, ``table``, ``trailing_delimiter``, ``first_part`` (the number of the first part).

    Every file is one split, which carries its part number; numbers are the natural order of the whole paths. A batch of a
    stream has the files that are new, numbered on from the ones before, so that a part's number never changes. A split reads its file line by line. Files are found and read by
    Arrow's file systems (local paths and the stores that Arrow knows); others are read by ``read_tbl_table``. Fields follow
    ``read_delimited``: empty is null, a value that does not parse, or a row with another number of fields, fails the read;
    there is no quoting, as in the files that the benchmark's generator writes.
    """

    @classmethod
    def name(cls) -> str:
        return "table_parts"

    def schema(self) -> T.StructType:
        return T.StructType([*TPCH_SCHEMAS[self.options["table"]].fields, T.StructField("part_idx", L)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PartsReader(dict(self.options), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _PartsStream(dict(self.options), schema)


class _Part(InputPartition):
    def __init__(self, path: str, number: int):
        self.path, self.number = path, number


def _found(options: dict) -> list[str]:
    """Paths of the table's files below ``path`` in natural order."""
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (fs.LocalFileSystem(), options["path"])
    infos = store.get_file_info(fs.FileSelector(root, recursive=True))
    wanted = [i.path for i in infos if i.type == fs.FileType.File and i.base_name.startswith(f"{options['table']}.tbl")]
    return sorted(wanted, key=natural_key)


_PARSE = {I: int, L: int, D: float, S: str, DT: datetime.date.fromisoformat}


def _rows_of(part: _Part, options: dict, schema: T.StructType):
    from pyarrow import fs
    store = fs.FileSystem.from_uri(options["path"])[0] if "://" in options["path"] else fs.LocalFileSystem()
    parse = [_PARSE[f.dataType] for f in schema.fields[:-1]]
    tail = options.get("trailing_delimiter", "false").lower() == "true"
    with store.open_input_stream(part.path) as raw:
        for number, line in enumerate(io.TextIOWrapper(raw, encoding="utf-8", newline="\n"), 1):
            line = line.rstrip("\r\n")
            if not line:
                continue
            own = line.split("|")
            if tail and own[-1] == "":
                own.pop()
            if len(own) != len(parse):
                raise ValueError(f"{part.path}, line {number}: {len(own)} fields instead of {len(parse)}")
            try:
                yield (*[p(x) if x else None for p, x in zip(parse, own)], part.number)
            except ValueError as e:
                raise ValueError(f"{part.path}, line {number}: {e}") from None


class _PartsReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema

    def partitions(self):
        files = _found(self.options)
        if not files:
            raise FileNotFoundError(f"no {self.options['table']}.tbl* under {self.options['path']}")
        first = int(self.options.get("first_part", "0"))
        return [_Part(f, first + i) for i, f in enumerate(files)]

    def read(self, partition: _Part):
        return _rows_of(partition, self.options, self.schema)


class _PartsStream(DataSourceStreamReader):
    """An offset holds the paths of all files there; a batch's parts are those that its end has and its start has not, numbered
    on from the start's count. So nothing is kept between calls, a batch that is run again has the same numbers, and a
    restart goes on from its checkpoint. Files once given must stay."""

    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema

    def initialOffset(self) -> dict:
        return {"files": []}

    def latestOffset(self) -> dict:
        return {"files": _found(self.options)}

    def partitions(self, start: dict, end: dict):
        have, first = set(start["files"]), int(self.options.get("first_part", "0")) + len(start["files"])
        return [_Part(f, first + i) for i, f in enumerate(f for f in end["files"] if f not in have)]

    def read(self, partition: _Part):
        return _rows_of(partition, self.options, self.schema)

    def commit(self, end: dict) -> None:
        pass


def table_parts(spark: SparkSession, directory: str, table: str, trailing_delimiter: bool = False) -> DataFrame:
    """A2: a table's rows with ``part_idx`` by the data source."""
    spark.dataSource.register(TablePartsSource)
    return (spark.read.format("table_parts").option("path", directory).option("table", table)
            .option("trailing_delimiter", str(trailing_delimiter).lower()).load())


def table_parts_stream(spark: SparkSession, directory: str, table: str, trailing_delimiter: bool = False) -> DataFrame:
    """The same as a stream, each batch the files that are new."""
    spark.dataSource.register(TablePartsSource)
    return (spark.readStream.format("table_parts").option("path", directory).option("table", table)
            .option("trailing_delimiter", str(trailing_delimiter).lower()).load())
