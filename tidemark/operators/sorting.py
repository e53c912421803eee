"""Total-order sort and its validation (E1, E2, E4, E5), TeraGen-like
records (A16).

``total_sort`` is a range-partitioned exchange followed by a per-partition
sort: no single task sees more than one range. ``validate_sort`` reads each
partition once in its stored order (``mapInPandas``: the check is per
partition, imperative and order-dependent) and reduces to one row per
partition; the boundary check then runs over those few rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_sort(df: DataFrame, keys: list[str | Column], n_parts: int | None = None) -> DataFrame:
    """Range partition on the keys, then sort inside each partition.
    Without ``n_parts`` the shuffle partition count applies and AQE sizes
    the ranges from the data.

    The ranges' splitters are sampled over the keys and, behind them, a hash of the row and its place in the input, so a
    key (or a row) that repeats for a third of the table covers as many ranges as its share, and keys still ascend over
    partitions."""
    spread = "__spread"
    own = F.xxhash64(*[_quoted(c) for c in df.columns], F.monotonically_increasing_id())
    d = df.withColumn(spread, own)
    ranged = d.repartitionByRange(n_parts, *keys, spread) if n_parts else d.repartitionByRange(*keys, spread)
    return ranged.sortWithinPartitions(*keys).drop(spread)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """``orderBy().limit(k)`` plans as TakeOrderedAndProject (a top-k per
    task, then a merge of k rows per task). ``order`` must end in a unique
    key so ties do not make the answer depend on the run."""
    return df.orderBy(*order).limit(k)


def row_checksum(*cols) -> Column:
    """Order-independent checksum term: CRC32 of the row's text form."""
    return F.crc32(F.concat_ws("\u0001", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                          for c in cols]))


def checksum(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sum of per-row CRC32 as an exact decimal (no overflow at any size)."""
    return df.agg(F.sum(row_checksum(*cols).cast("decimal(38,0)")).alias("checksum"),
                  F.count(F.lit(1)).alias("rows"))


def _cmp_sign(a, b):
    """-1/0/1 comparing aligned numpy arrays (numbers or strings)."""
    import numpy as np
    return np.where(a < b, -1, np.where(a > b, 1, 0))


def _partition_summary(keys: list[str], desc: list[bool]):
    import numpy as np

    def run(batches):
        pid, n, first, last, inversions = None, 0, None, None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["__pid"].iloc[0])
            cur = [pdf[k].to_numpy() for k in keys]
            if last is not None:   # join with the previous batch's last row
                cur = [np.concatenate([[lv], c]) for lv, c in zip(last, cur)]
            elif first is None:
                first = [c[0] for c in cur]
            if len(cur[0]) > 1:
                # lexicographic order with per-key direction: the first
                # differing key decides; it must not go backwards
                decided = np.zeros(len(cur[0]) - 1, dtype=bool)
                bad = np.zeros(len(cur[0]) - 1, dtype=bool)
                for c, d in zip(cur, desc):
                    sgn = _cmp_sign(c[1:], c[:-1]) * (-1 if d else 1)
                    bad |= (~decided) & (sgn < 0)
                    decided |= sgn != 0
                inversions += int(bad.sum())
            last = [c[-1] for c in cur]
            n += len(pdf)
        if pid is not None:
            row = {"pid": [pid], "n": [n], "inversions": [inversions]}
            for i, k in enumerate(keys):
                row[f"f{i}"] = [first[i]]
                row[f"l{i}"] = [last[i]]
            yield pd.DataFrame(row)
    return run


def _lex_le(a: list, b: list, desc: list[bool]):
    """Spark expression: row a comes no later than row b in the order."""
    if not a:
        return F.lit(True)
    x, y, d = a[0], b[0], desc[0]
    before = (x > y) if d else (x < y)
    return before | ((x == y) & _lex_le(a[1:], b[1:], desc[1:]))


def _comparable(df: DataFrame, name: str) -> list[Column]:
    """A key as columns without nulls that compare as Spark sorts it: nulls before all values (last if
    descending), NaN after all numbers (first if descending)."""
    key, kind = F.col(name), df.schema[name].dataType.simpleString()
    fill = {"date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01", "boolean": "false"}.get(kind, "0")
    none = F.lit(fill).cast(df.schema[name].dataType)
    out = [key.isNotNull().cast("int")]
    if kind in ("double", "float"):
        nan = F.coalesce(F.isnan(key), F.lit(False))
        out.append(nan.cast("int"))
        key = F.when(~nan, key)
    return out + [F.coalesce(key, none)]


def validate_sort(df: DataFrame, key, cols: list[str] | None = None,
                  descending: list[bool] | None = None) -> DataFrame:
    """E5: one row ``(partitions, rows, partitions_sorted, boundaries_ordered,
    checksum)``. ``key`` is a column name or a list of them (lexicographic,
    ``descending`` per key; nulls and NaN as Spark sorts them). Each partition
    is read once in stored order; partitions are then taken in partition-id
    order."""
    named = [key] if isinstance(key, str) else list(key)
    each = [_comparable(df, k) for k in named]
    desc = [d for d, own in zip(descending or [False] * len(named), each) for _ in own]
    plain = df.select(F.spark_partition_id().alias("__pid"),
                      *[x.alias(f"k{i}") for i, x in enumerate(x for own in each for x in own)])
    keys = plain.columns[1:]
    types = [plain.schema[k].dataType.simpleString() for k in keys]
    schema = ", ".join(["pid int", "n long", "inversions long"]
                       + [f"f{i} {t}" for i, t in enumerate(types)] + [f"l{i} {t}" for i, t in enumerate(types)])
    summ = plain.mapInPandas(_partition_summary(keys, desc), schema)
    w = Window.orderBy("pid")
    checks = summ.select("*", *[F.lag(f"l{i}").over(w).alias(f"p{i}") for i in range(len(keys))])
    ok = _lex_le([F.col(f"p{i}") for i in range(len(keys))], [F.col(f"f{i}") for i in range(len(keys))], desc)
    agg = checks.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"),
        (F.sum("inversions") == 0).alias("partitions_sorted"),
        (F.sum(F.when(F.col("p0").isNotNull() & ~ok, 1).otherwise(0)) == 0).alias("boundaries_ordered"))
    cs = checksum(df, cols or df.columns).select("checksum")
    return side_by_side(agg, cs)


def side_by_side(one_row: DataFrame, *others: DataFrame) -> DataFrame:
    """Put single-row results next to each other: each further frame's
    columns become scalar subqueries (computed once), not a join."""
    out = one_row
    for o in others:
        for c in o.columns:
            out = out.withColumn(c, o.select(c).scalar())
    return out


def _split_summary(key: str):
    """Per file split, in stored order: rows, first/last/min/max key,
    out-of-order steps and the sum of row checksums. Vectorised per Arrow
    batch; a split continuing into the next batch is merged on the way."""
    def summarise(pdf):
        seg = ((pdf["__file"] != pdf["__file"].shift()) | (pdf["__start"] != pdf["__start"].shift())).cumsum()
        k = pdf[key]
        inv = (k < k.shift()) & (seg == seg.shift())
        g = pd.DataFrame({"seg": seg, "file": pdf["__file"], "start": pdf["__start"], "k": k,
                          "inv": inv.astype("int64"), "crc": pdf["__crc"].astype("int64")}).groupby("seg", sort=True)
        return pd.DataFrame({"file": g["file"].first(), "start": g["start"].first(), "n": g.size(),
                             "first_key": g["k"].first(), "last_key": g["k"].last(), "kmin": g["k"].min(),
                             "kmax": g["k"].max(), "inversions": g["inv"].sum(), "crc": g["crc"].sum()})

    def merge(a, b):
        # b continues the split a ended with
        return {"file": a["file"], "start": a["start"], "n": a["n"] + b["n"], "first_key": a["first_key"],
                "last_key": b["last_key"], "kmin": min(a["kmin"], b["kmin"]), "kmax": max(a["kmax"], b["kmax"]),
                "inversions": a["inversions"] + b["inversions"] + int(a["last_key"] > b["first_key"]),
                "crc": a["crc"] + b["crc"]}

    def run(batches):
        rows, pending = [], None
        for pdf in batches:
            if pdf.empty:
                continue
            recs = summarise(pdf).to_dict("records")
            if pending is not None and (recs[0]["file"], recs[0]["start"]) == (pending["file"], pending["start"]):
                recs[0] = merge(pending, recs[0])
            elif pending is not None:
                rows.append(pending)
            rows.extend(recs[:-1])
            pending = recs[-1]
        if pending is not None:
            rows.append(pending)
        if rows:
            out = pd.DataFrame(rows)
            out["crc"] = out["crc"].astype(str)
            yield out[["file", "start", "n", "first_key", "last_key", "kmin", "kmax", "inversions", "crc"]]
    return run


def validate_sorted_files(spark, path: str, key: str, cols: list[str]) -> DataFrame:
    """E5 on a written sort output (as TeraValidate reads the files): each
    file split is read once in stored order; files are ordered by their
    part number. One row ``(rows, min_key, max_key, partitions_sorted,
    boundaries_ordered, checksum)``. The per-split summary table has one row
    per split (metadata-sized)."""
    df = spark.read.parquet(path)
    kt = df.schema[key].dataType.simpleString()
    src = df.select(F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                    F.col(key), row_checksum(*cols).alias("__crc"))
    summ = src.mapInPandas(_split_summary(key),
                           f"file string, start long, n long, first_key {kt}, last_key {kt}, kmin {kt}, "
                           f"kmax {kt}, inversions long, crc string")
    summ = summ.withColumn("part_no", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
    w = Window.orderBy("part_no", "file", "start")
    checks = summ.withColumn("prev_last", F.lag("last_key").over(w))
    return checks.agg(
        F.sum("n").alias("rows"), F.min("kmin").alias("min_key"), F.max("kmax").alias("max_key"),
        (F.sum("inversions") == 0).alias("partitions_sorted"),
        (F.sum(F.when(F.col("prev_last") > F.col("first_key"), 1).otherwise(0)) == 0).alias("boundaries_ordered"),
        F.sum(F.col("crc").cast("decimal(38,0)")).alias("checksum"))


# Multiplier of the published 128-bit PCG generator; its increment is any odd number.
LCG_MULT = 47026247687942121848144207491837523525
LCG_ADD = 0x14057B7EF767814F
KEY_BYTES, ID_BYTES, RECORD_BYTES = 10, 32, 100
LETTERS = 94  # printable characters after the space


def lcg_state(n: int, seed: int = 0) -> int:
    """The n-th state of the generator, by squaring (one state at a time; for checks)."""
    mult, add, a, c = LCG_MULT, LCG_ADD, 1, 0
    while n:
        if n & 1:
            a, c = a * mult % (1 << 128), (c * mult + add) % (1 << 128)
        mult, add = mult * mult % (1 << 128), (mult + 1) * add % (1 << 128)
        n >>= 1
    return (a * seed + c) % (1 << 128)


def _times(hi, lo, by: int):
    """Numbers of 128 bits (high and low halves) times a constant, modulo 2**128."""
    import numpy as np
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    b_hi, b_lo = np.uint64(by >> 64), np.uint64(by & (1 << 64) - 1)
    x0, x1, y0, y1 = lo & low, lo >> half, b_lo & low, b_lo >> half
    mid = x1 * y0 + (x0 * y0 >> half)
    mid2 = x0 * y1 + (mid & low)
    return hi * b_lo + lo * b_hi + x1 * y1 + (mid >> half) + (mid2 >> half), lo * b_lo


def record_keys(ids, seed: int = 0):
    """Printable 10-byte keys of row ids: each the generator's state after as many steps as its id says, reached by
    skipping ahead one binary digit at a time, so a key depends on its id alone."""
    import numpy as np
    n = ids.astype(np.uint64)
    hi, lo = np.full(len(n), seed >> 64, np.uint64), np.full(len(n), seed & (1 << 64) - 1, np.uint64)
    mult, add = LCG_MULT, LCG_ADD
    for bit in range(64):
        on = (n >> np.uint64(bit) & np.uint64(1)).astype(bool)
        if on.any():
            h, low = _times(hi, lo, mult)
            new = low + np.uint64(add & (1 << 64) - 1)
            h = h + np.uint64(add >> 64) + (new < low)
            hi, lo = np.where(on, h, hi), np.where(on, new, lo)
        mult, add = mult * mult % (1 << 128), (mult + 1) * add % (1 << 128)
    out = np.zeros((len(n), KEY_BYTES), np.uint8)
    for i in range(KEY_BYTES):
        from_ = hi if i < 9 else lo >> np.uint64(32)
        out[:, i] = (from_ % np.uint64(LETTERS)).astype(np.uint8) + 33
        hi = hi // np.uint64(LETTERS)
    return [x.tobytes().decode("ascii") for x in out]


def tera_records(ids: DataFrame, id_col: str = "id", seed: int = 0) -> DataFrame:
    """For each row id (a non-negative long) a record of exactly 100 bytes: 10 bytes of key, the whole id as 32 hex digits, 58 bytes of
    filler. The same ids give the same records however they are partitioned."""
    @F.pandas_udf("string")
    def key(own: pd.Series) -> pd.Series:
        return pd.Series(record_keys(own.to_numpy(), seed), index=own.index)

    n = _quoted(id_col).cast("long")
    return ids.select(key(n).alias("key"), F.lpad(F.hex(n), ID_BYTES, "0").alias("rowid"),
                      F.repeat(F.lit("X"), F.lit(RECORD_BYTES - KEY_BYTES - ID_BYTES)).alias("filler"))


def teragen(spark, n: int, seed: int = 0) -> DataFrame:
    """The records of row ids 0 to n - 1."""
    return tera_records(spark.range(n), "id", seed)
