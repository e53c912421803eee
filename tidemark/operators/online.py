"""Online aggregation, batch form.

The input is split in an ordered sequence of parts (files, or a part index
column). For every part p the operator emits the answer over parts <= p:
one snapshot per part, the last one exact.

Plan (no cross join, nothing gathered in one task):

1. partial states per (part, keys) -- a grouped aggregate, map-side combined,
   so a hot key costs one row per part after the partial step;
2. running merge of the states per key over the part order -- a window over
   at most ``n_parts`` rows per key; with an :class:`Accumulator` that only its own ``merge`` can join, a fold over the
   key's array of at most ``n_parts`` states;
3. a key absent from some later parts keeps its last value: each partial row
   is expanded with ``sequence(part, next_part - 1)``; the output size is
   the size of the answer (snapshots x keys present), nothing more;
4. progress per part (rows seen so far / rows in total) is an ``n_parts``-row
   table, so it can be broadcast without growing with the data.

Aggregate functions follow one partial / merge / finish protocol (K2), in batch and on streams, so
``min``, ``max`` and ``avg`` merge correctly (avg is the mergeable pair
(sum, count), D9).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import rnd, sql_rnd


def _e(x) -> Column:
    return F.expr(x) if isinstance(x, str) else x


class Accumulator:
    """A running aggregate (K2): partial state of a group of rows, merge of two states, value of a state. All three are
    Columns, a state may have any type, and the same object runs in :func:`online_agg` and
    :func:`tidemark.streaming.online_stream.online_agg_stream`. ``merge`` is given the state of the earlier rows first;
    null states (no rows) never reach it."""

    name: str
    digits: int | None = None    # round the finished value (doubles)

    def partial(self) -> Column:
        """Aggregate over the rows of a group."""
        raise NotImplementedError

    def merge(self, a: Column, b: Column) -> Column:
        raise NotImplementedError

    def finish(self, state: Column) -> Column:
        return state

    def fields(self) -> list[tuple[str, Column, str]] | None:
        """For states that plain SQL aggregates merge: their fields as (name, partial, merging aggregate), which Spark
        can then merge itself. None: by ``merge`` alone."""
        return None

    def value(self, state: Column) -> Column:
        """The finished, rounded value under the aggregate's name."""
        v = self.finish(state)
        return (v if self.digits is None else rnd(v, self.digits)).alias(self.name)


@dataclass
class Agg(Accumulator):
    """A built-in aggregate. ``expr`` is SQL text or a Column (None: rows)."""
    name: str
    op: str                      # sum | count | avg | min | max | count_star | last
    expr: str | Column | None = None
    digits: int | None = None
    order: str | None = None     # for ``last``: SQL text giving the input order

    def fields(self) -> list[tuple[str, Column, str]]:
        x = _e(self.expr) if self.expr is not None else None
        if self.op == "last":
            if not self.order:
                raise ValueError("a 'last' aggregate needs an explicit order")
            o = F.expr(self.order)
            return [("m", F.max(F.when(o.isNotNull(), F.struct(o.alias("o"), x.alias("v")))), "max")]
        made = {"sum": lambda: [("s", F.sum(x), "sum")], "count": lambda: [("c", F.count(x), "sum")],
                "count_star": lambda: [("c", F.count(F.lit(1)), "sum")],
                "avg": lambda: [("s", F.sum(x), "sum"), ("c", F.count(x), "sum")],
                "min": lambda: [("m", F.min(x), "min")], "max": lambda: [("m", F.max(x), "max")]}
        if self.op not in made:
            raise ValueError(f"unsupported online aggregate {self.op!r}")
        return made[self.op]()

    def partial(self) -> Column:
        return F.struct(*[x.alias(n) for n, x, _ in self.fields()])

    def merge(self, a: Column, b: Column) -> Column:
        def field(n, op):
            x, y = a[n], b[n]
            if op == "sum":
                return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(x + y)
            return (F.least if op == "min" else F.greatest)(x, y) if self.op != "last" else \
                F.when(x.isNull() | (y > x), y).otherwise(x)
        return F.struct(*[field(n, op).alias(n) for n, _, op in self.fields()])

    def finish(self, state: Column) -> Column:
        if self.op in ("count", "count_star"):
            return state["c"].cast("bigint")
        if self.op == "avg":
            return F.try_divide(state["s"].cast("double"), state["c"])
        if self.op == "sum":
            return state["s"]
        return state["m"]["v"] if self.op == "last" else state["m"]

    def value(self, state: Column) -> Column:
        v = self.finish(state)
        return (v if self.digits is None or self.op in ("count", "count_star") else rnd(v, self.digits)).alias(self.name)


def merged_states(spec: OnlineSpec, a: Column, b: Column) -> Column:
    """One struct of all states, from the states of earlier and later rows."""
    return F.struct(*[F.when(a[x.name].isNull(), b[x.name]).when(b[x.name].isNull(), a[x.name])
                      .otherwise(x.merge(a[x.name], b[x.name])).alias(x.name) for x in spec.aggs])


@dataclass
class Derived:
    """A column computed on each snapshot from finished aggregates."""
    name: str
    expr: str
    digits: int | None = None


@dataclass
class OnlineSpec:
    keys: list[str]
    aggs: list[Accumulator]
    derived: list[Derived] = field(default_factory=list)
    hidden: list[str] = field(default_factory=list)   # aggregates only used by derived


def online_agg(df: DataFrame, part_col: str | Column, n_parts: int, spec: OnlineSpec,
               part_name: str = "part_idx", with_progress: bool = True) -> DataFrame:
    """Snapshots ``(part_idx, keys..., aggregates..., rows_seen, rows_total, progress)``.

    ``part_col`` must take values in ``0 .. n_parts - 1``; a row with any other
    part, or none, fails the query. A ``last`` aggregate is the value of the
    largest order over all parts seen (of equal orders the largest value),
    whatever part it came in; null orders are left out.
    The partial states (parts x keys rows) are persisted for their two
    consumers; a long-lived session releases them with
    ``spark.catalog.clearCache()``.
    """
    keys = list(spec.keys)
    part = (F.expr(part_col) if isinstance(part_col, str) else part_col).cast("bigint")
    legal = part.between(0, n_parts - 1)
    src = df.withColumn(part_name, F.when(legal, part).otherwise(F.raise_error(
        F.concat(F.lit(f"part outside 0..{n_parts - 1}: "), F.coalesce(part.cast("string"), F.lit("null"))))))
    # the partial states feed both the snapshots and the progress table; they
    # are small (parts x keys) and kept so the input is scanned once
    partial = (src.groupBy(part_name, *keys)
               .agg(*[a.partial().alias(f"__{a.name}") for a in spec.aggs], F.count(F.lit(1)).alias("__rows"))
               .persist(StorageLevel.MEMORY_AND_DISK))
    running = (_window_merge if all(a.fields() for a in spec.aggs) else _fold_merge)(partial, keys, n_parts, spec, part_name)
    snap = running.withColumn(part_name, F.explode(F.sequence(part_name, F.greatest(F.col(part_name), F.col("__until")))))
    res = snap.select(part_name, *keys, *[a.value(F.col(f"__{a.name}")) for a in spec.aggs])
    if spec.derived:
        res = res.selectExpr("*", *[f"{sql_rnd(d.expr, d.digits) if d.digits is not None else d.expr} AS {d.name}"
                                    for d in spec.derived])
    if spec.hidden:
        res = res.drop(*spec.hidden)

    if with_progress:
        counts = partial.groupBy(part_name).agg(F.expr("sum(__rows) AS __n"))
        res = res.join(F.broadcast(progress(counts, part_name, n_parts)), part_name)
    return res


def _window_merge(partial: DataFrame, keys: list[str], n_parts: int, spec: OnlineSpec, part_name: str) -> DataFrame:
    """States merged over the parts so far by windowed SQL aggregates of their fields."""
    w = Window.partitionBy(*keys).orderBy(part_name)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    return partial.select(
        part_name, *keys, *[F.struct(*[merge[op](F.col(f"__{a.name}.{n}")).over(so_far).alias(n) for n, _, op in a.fields()])
                            .alias(f"__{a.name}") for a in spec.aggs],
        F.coalesce(F.lead(part_name).over(w) - 1, F.lit(n_parts - 1).cast("bigint")).alias("__until"))


def _fold_merge(partial: DataFrame, keys: list[str], n_parts: int, spec: OnlineSpec, part_name: str) -> DataFrame:
    """The same by the accumulators' own merge: one fold over each key's states in the order of the parts."""
    entry = F.struct(F.col(part_name).alias("part"), F.struct(*[F.col(f"__{a.name}").alias(a.name) for a in spec.aggs]).alias("state"))
    by_part = lambda a, b: F.when(a["part"] < b["part"], -1).when(a["part"] > b["part"], 1).otherwise(0)
    own = partial.groupBy(*keys).agg(F.array_sort(F.collect_list(entry), by_part).alias("__own"))
    last = lambda xs: F.element_at(xs, -1)["state"]
    folded = F.aggregate(
        F.slice("__own", F.lit(2), F.greatest(F.size("__own") - 1, F.lit(0))), F.slice("__own", 1, 1),
        lambda done, x: F.concat(done, F.array(F.struct(x["part"].alias("part"), merged_states(spec, last(done), x["state"]).alias("state")))))
    each = own.select(*keys, folded.alias("__own")).select(*keys, "__own", F.posexplode("__own").alias("__i", "__x"))
    return each.select(F.col("__x.part").alias(part_name), *keys, *[F.col("__x.state")[a.name].alias(f"__{a.name}") for a in spec.aggs],
                       F.coalesce(F.get("__own", F.col("__i") + 1)["part"] - 1, F.lit(n_parts - 1).cast("bigint")).alias("__until"))


def progress(counts: DataFrame, part_name: str, n_parts: int) -> DataFrame:
    """Per part, rows seen up to it, rows in total, and their ratio.

    ``counts`` holds rows per part (column ``__n``), taken from the partial
    aggregate so the input is not scanned a second time. Built on an
    ``n_parts``-row grid so empty parts still report."""
    spark = counts.sparkSession
    grid = spark.range(n_parts).withColumnRenamed("id", part_name)
    dense = grid.join(F.broadcast(counts), part_name, "left")
    return dense.selectExpr(
        part_name,
        f"CAST(sum(coalesce(__n, 0)) OVER (ORDER BY {part_name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        " AS BIGINT) AS rows_seen",
        "CAST(sum(coalesce(__n, 0)) OVER () AS BIGINT) AS rows_total").selectExpr(
        "*", f"{sql_rnd('try_divide(CAST(rows_seen AS DOUBLE), rows_total)', 4)} AS progress")


def final_snapshot(snapshots: DataFrame, n_parts: int, part_name: str = "part_idx") -> DataFrame:
    """The exact answer: the snapshot of the last part."""
    return snapshots.where(F.col(part_name) == n_parts - 1)


def file_parts(df: DataFrame, part_name: str = "part_idx") -> tuple[DataFrame, int]:
    """A2: one part per input file, numbered in natural order of the paths
    (``x.tbl.2`` before ``x.tbl.10``), and the number of parts."""
    from tidemark.sources.files import with_file_part
    return with_file_part(df, part_name)


# ---------------------------------------------------------------- SQL twin

def online_sql(base: str, part_expr: str, n_parts: int, spec: OnlineSpec, round_sql: Callable,
               as_cte: str | None = None) -> str:
    """DuckDB text computing the same snapshots with a dense grid and
    window sums (the independent check for :func:`online_agg`).

    ``base`` is a SELECT producing the input rows."""
    keys = spec.keys
    kl = ", ".join(keys)
    kcomma = (kl + ", ") if keys else ""
    st, fin = [], []
    for a in spec.aggs:
        x = a.expr if isinstance(a.expr, str) else None
        n = a.name
        if a.op == "sum":
            st += [(f"sum({x})", f"{n}__s", "sum")]
            v = f"{n}__s"
        elif a.op == "count":
            st += [(f"count({x})", f"{n}__c", "sum")]
            v = f"CAST({n}__c AS BIGINT)"
        elif a.op == "count_star":
            st += [("count(*)", f"{n}__c", "sum")]
            v = f"CAST({n}__c AS BIGINT)"
        elif a.op == "avg":
            st += [(f"sum({x})", f"{n}__s", "sum"), (f"count({x})", f"{n}__c", "sum")]
            v = f"CAST({n}__s AS DOUBLE) / NULLIF({n}__c, 0)"
        elif a.op in ("min", "max"):
            st += [(f"{a.op}({x})", f"{n}__m", a.op)]
            v = f"{n}__m"
        else:
            raise ValueError(a.op)
        if a.digits is not None and a.op not in ("count", "count_star"):
            v = round_sql(v, a.digits)
        fin.append(f"{v} AS {n}")
    part_states = ", ".join(f"{e} AS {nm}" for e, nm, _ in st)
    run_states = ", ".join(f"{m}({nm}) OVER w AS {nm}" for _, nm, m in st)
    grid_keys = f", (SELECT DISTINCT {kl} FROM partial) k" if keys else ""
    join_on = " AND ".join([f"g.{k} IS NOT DISTINCT FROM p.{k}" for k in keys] + ["g.part_idx = p.part_idx"])
    gsel = ", ".join(["g.part_idx"] + [f"g.{k}" for k in keys])
    psel = ", ".join([f"p.{nm}" for _, nm, _ in st] + ["p.__rows"])
    part_by = f"PARTITION BY {kl} " if keys else ""
    outer = ", ".join(["s.part_idx"] + [f"s.{k}" for k in keys] + fin)
    sql = f"""
, base AS ({base}),
src AS (SELECT CAST({part_expr} AS BIGINT) AS part_idx, * FROM base),
partial AS (SELECT part_idx, {kcomma}{part_states}, count(*) AS __rows FROM src GROUP BY ALL),
grid AS (SELECT p.range AS part_idx{', k.*' if keys else ''} FROM range({n_parts}) p{grid_keys}),
dense AS (SELECT {gsel}, {psel} FROM grid g LEFT JOIN partial p ON {join_on}),
run AS (SELECT part_idx, {kcomma}{run_states}, sum(__rows) OVER w AS __rows FROM dense
        WINDOW w AS ({part_by}ORDER BY part_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cnt AS (SELECT part_idx, count(*) AS n FROM src GROUP BY part_idx),
prog AS (SELECT p.range AS part_idx,
                CAST(sum(coalesce(cnt.n, 0)) OVER (ORDER BY p.range ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_seen,
                CAST(sum(coalesce(cnt.n, 0)) OVER () AS BIGINT) AS rows_total
         FROM range({n_parts}) p LEFT JOIN cnt ON cnt.part_idx = p.range),
s AS (SELECT * FROM run WHERE __rows > 0),
fin AS (SELECT {outer} FROM s)
SELECT fin.*, prog.rows_seen, prog.rows_total,
       {round_sql('CAST(prog.rows_seen AS DOUBLE) / NULLIF(prog.rows_total, 0)', 4)} AS progress
FROM fin JOIN prog ON fin.part_idx = prog.part_idx
"""
    if as_cte:
        i = sql.rindex("SELECT fin.*")
        sql = sql[:i] + f", {as_cte} AS (" + sql[i:] + ")\n"
    if spec.derived or spec.hidden:
        dcols = ", ".join(f"{round_sql(d.expr, d.digits) if d.digits is not None else d.expr} AS {d.name}"
                          for d in spec.derived)
        excl = f" EXCLUDE ({', '.join(spec.hidden)})" if spec.hidden else ""
        sql = sql.replace("SELECT fin.*,", f"SELECT fin.*{excl}{', ' + dcols if dcols else ''},", 1)
    return sql
