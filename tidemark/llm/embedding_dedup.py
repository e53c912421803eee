"""Embedding near-dedup (operator 4): passes that sort by random hashes and compare neighbours.

A pass gives each distinct vector a key of concatenated hashes. A hash is the signs of random projections, taken from
the mean of the run of vectors that share the key so far, so a dense cluster is cut at its own middle; runs of more
than ``window`` vectors get a further hash until windows suffice. A run whose vectors have a mean cosine of
``least`` or more holds little but links and is dealt to slices at random. The keys are sorted, the order is cut into
blocks of about ``window`` vectors that keep runs whole, and each block is compared, in double precision, with itself
and the next. Verified links of all passes are united; the components of the union are groups. Inside a group, cut
into blocks of ``block`` vectors, every pair is compared once more, so a vector's links are all counted however many
they are, without a row for a pair.

The same is done at every size; a table of up to ``window`` vectors is one block. The number of passes comes from
measured recall: about ``PROBES`` vectors of each length (all, in smaller tables) get a partner at the cosine
``least`` in a random direction, which is sorted with them but not counted, and passes are added until all but ``MISS``
of the partners have stood in a window with a vector they are linked to. Each pass reads and exchanges the vectors
once (a quarter of them twice), ``ROUND`` passes at a time. Projections are sums of whole numbers, so a row that is
hashed again gets the same key. Equal vectors are one class with a multiplicity from the start, so a vector that fills
a third of the table is one row.

Defined cases: a vector that is null, empty, all zero, or has a null, NaN or infinite component is linked with
nothing (its own component, kept). Vectors of different lengths are never linked. Rows that repeat a vec_id
are vectors of their own. A null vec_id counts as larger than any and comes out null. An empty table gives no rows.
Labels and further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let_go, stored, table
from tidemark.llm.components import by_key, components, in_blocks
from tidemark.llm.registry import register

BLOCK = 4000
WINDOW = 2000
SPAN = 4  # blocks that a task's group owns
ROUND = 4
LEVELS = 8
PROBES = 2048
MISS = 0.002


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors, one a row."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _hashes(off: np.ndarray, number: int, level: int, seed: int) -> np.ndarray:
    """16 signs of random projections, the first one highest. Whole numbers, so no order of adding changes a sign."""
    rng = np.random.Generator(np.random.PCG64([seed, number, level, off.shape[1]]))
    planes = np.rint(rng.standard_normal((off.shape[1], 16)) * 256)
    return (np.rint(off * (1 << 20)) @ planes > 0) @ (1 << np.arange(15, -1, -1))


def _dealt(name: list[bytes], probe: np.ndarray, number: int, level: int) -> np.ndarray:
    """Evenly spread numbers of (class, probe, pass, level)."""
    h = np.frombuffer(b"".join(name), np.uint64)[::2] + np.uint64(0x9E3779B97F4A7C15) * (1 + probe.astype(np.uint64) + np.uint64(2 * number + (level << 32)))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _parts(b: pa.RecordBatch):
    """Rows of one length and pass after the other, as row numbers."""
    dim, number = b.column("dim").to_numpy(), b.column("pass").to_numpy()
    for d, p in sorted(set(zip(dim.tolist(), number.tolist()))):
        yield d, p, np.flatnonzero((dim == d) & (number == p))


def _extend(batches, level: int, window: int, least: float, seed: int):
    """Runs that have a centre get one more hash of as many bits as they need, or a random slice."""
    for b in batches:
        run = b.column("run").to_pylist()
        for dim, number, at in _parts(b):
            at = at[b.column("centre").is_valid().to_numpy(zero_copy_only=False)[at]]
            if not len(at):
                continue
            own = b.take(pa.array(at))
            centre = np.frombuffer(b"".join(own.column("centre").to_pylist()), np.float64).reshape(len(at), dim)
            n = own.column("n").to_numpy()
            bits = np.clip(np.ceil(np.log2(n / (window / 8))), 1, 16).astype(np.int64)
            more = _hashes(_unit(own.column("vec").to_pylist(), dim) - centre, number, level, seed) >> 16 - bits << 32 - bits
            slices = (_dealt(own.column("class").to_pylist(), own.column("probe").to_numpy(zero_copy_only=False), number, level)
                      % (-(-2 * n // window)).astype(np.uint64)).astype(np.int64)
            more = np.where(((centre * centre).sum(1) >= least) | (level == LEVELS - 1), slices, more)
            for k, v in zip(at.tolist(), more.tolist()):
                run[k] += v.to_bytes(4, "big")
        yield pa.RecordBatch.from_arrays([b.column("dim"), b.column("pass"), pa.array(run, pa.binary()), b.column("class"),
                                          b.column("vec"), b.column("probe")], names=["dim", "pass", "run", "class", "vec", "probe"])


def _sums(batches):
    """Sums of unit vectors by run, given on whenever many runs are held."""
    sums: dict[tuple, np.ndarray] = {}

    def out():
        if sums:
            dim, number, run = zip(*sums)
            yield pa.RecordBatch.from_arrays([pa.array(dim, pa.int32()), pa.array(number, pa.int32()), pa.array(run, pa.binary()),
                                              pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["dim", "pass", "run", "part"])
            sums.clear()

    for b in batches:
        for dim, number, at in _parts(b):
            own = b.take(pa.array(at))
            name = own.column("run").dictionary_encode()
            x = _unit(own.column("vec").to_pylist(), dim)
            for k, run in enumerate(name.dictionary.to_pylist()):
                v = x[name.indices.to_numpy() == k].sum(0)
                key = (dim, number, run)
                sums[key] = sums[key] + v if key in sums else v
        if len(sums) > 4096:
            yield from out()
    yield from out()


def _centre(group: pa.Table) -> pa.Table:
    parts = group["part"].to_pylist()
    mean = np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1).sum(0) / group["n"][0].as_py()
    return group.slice(0, 1).select(["dim", "pass", "run", "n"]).append_column("centre", pa.array([mean.tobytes()], pa.binary()))


def _partners(batches, least: float, seed: int):
    """A vector at the cosine ``least`` in a direction drawn from the row's class."""
    for b in batches:
        out = []
        for dim, name, raw in zip(b.column("dim").to_pylist(), b.column("class").to_pylist(), b.column("vec").to_pylist()):
            a = _unit([raw], dim)[0]
            off = np.random.Generator(np.random.PCG64([seed, int.from_bytes(name, "big")])).standard_normal(dim)
            off -= (off @ a) * a
            size = np.sqrt(off @ off)
            out.append((least * a + np.sqrt(1 - least * least) * off / size if dim > 1 and size > 0 else a).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("dim"), b.column("class"), pa.array(out, pa.binary())], names=["dim", "class", "vec"])


def _bytes_of(batches):
    """vec_id and the vector's components as doubles; null for a vector that links with nothing."""
    for b in batches:
        vectors = b.column("v").cast(pa.list_(pa.float64()))
        flat, off = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
        bad = ~np.isfinite(flat)  # null components arrive as NaN
        size = np.diff(off)
        odd = np.r_[0, np.cumsum(bad)]
        some = np.r_[0, np.cumsum(flat != 0)]
        good = ((odd[off[1:]] == odd[off[:-1]]) & (some[off[1:]] > some[off[:-1]]) & (size > 0)
                & vectors.is_valid().to_numpy(zero_copy_only=False))
        flat = flat + 0.0  # one zero
        out = [flat[lo:hi].tobytes() if ok else None for lo, hi, ok in zip(off[:-1], off[1:], good)]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vec"])


def _spanning(count: int, pairs) -> list[tuple[int, int]]:
    up = list(range(count))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _searched(x: np.ndarray, among: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that connect what is linked in ``among``, by a search that compares each vector once and lists no pairs."""
    out, rest = [], among
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            found = []
            for lo in range(0, len(front), 256):
                part = front[lo:lo + 256]
                near = x[part] @ x[rest].T >= least
                hit = near.any(0)
                out += zip(part[near.argmax(0)[hit]].tolist(), rest[hit].tolist())
                found.append(rest[hit])
                rest = rest[~hit]
            front = np.concatenate(found)
    return out


def _connecting(x: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that connect whatever links of ``a`` with ``b`` (the same, or disjoint) connect."""
    linked, pairs, many = np.zeros(len(x), bool), [], 0
    for lo in range(0, len(a), 256):
        part = a[lo:lo + 256]
        near = x[part] @ x[b].T >= least
        near &= part[:, None] != b[None, :]
        i, j = near.any(1), near.any(0)
        linked[part[i]] = linked[b[j]] = True
        many += np.count_nonzero(near)
        if many <= 8 * len(x):
            i, j = np.nonzero(near)
            pairs += zip(part[i].tolist(), b[j].tolist())
    return _spanning(len(x), pairs) if many <= 8 * len(x) else _searched(x, np.flatnonzero(linked), least)


def _of_run(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (dim, pass, run) through the struct form, so that AQE can split a run with very many rows."""
    r = right.withColumnsRenamed({"dim": "_d", "pass": "_p", "run": "_r"})
    return left.join(r, F.struct("dim", "pass", "run") == F.struct("_d", "_p", "_r"), how).drop("_d", "_p", "_r")


def _sorted_blocks(base: DataFrame, dims: DataFrame, passes: range, window: int, least: float, seed: int) -> DataFrame:
    """``base`` once for each pass, with the block of each row in that pass's order."""
    number = F.explode(F.array(*[F.lit(p) for p in passes]))
    rows = base.withColumn("pass", number).withColumn("run", F.lit(b""))
    runs = dims.withColumn("pass", number).withColumn("run", F.lit(b""))
    for level in range(LEVELS):
        large = runs.where(F.col("n") > window)
        if large.isEmpty():
            break
        sums = _of_run(rows.where("not probe"), large).select("dim", "pass", "run", "vec").mapInArrow(_sums, "dim int, pass int, run binary, part binary")
        centres = stored(_of_run(sums, large).groupBy("dim", "pass", "run")
                         .applyInArrow(_centre, "dim int, pass int, run binary, n long, centre binary"), "centres")
        rows = _of_run(rows, centres, "left").mapInArrow(
            lambda batches, level=level: _extend(batches, level, window, least, seed),
            "dim int, pass int, run binary, class binary, vec binary, probe boolean")
        runs = stored(rows.groupBy("dim", "pass", "run").agg(F.count(F.when(~F.col("probe"), 1)).alias("n")), "runs")
    # where each run starts: totals of the first hash's runs (at most 2**16, or the slices), then inside each
    runs = runs.withColumn("first", F.substring("run", 1, 4))
    whole = (runs.groupBy("dim", "pass", "first").agg(F.sum("n").alias("own"))
             .select("dim", "pass", "first", (F.sum("own").over(Window.partitionBy("dim", "pass").orderBy("first")) - F.col("own")).alias("before")))
    inside = F.sum("n").over(Window.partitionBy("dim", "pass", "first").orderBy("run")) - F.col("n")
    starts = runs.withColumn("inside", inside).join(whole, ["dim", "pass", "first"])
    blocks = starts.select("dim", "pass", "run", F.expr(f"(before + inside) div {window}").alias("at"))
    return _of_run(rows, stored(blocks, "blocks"))


def _linked(base: DataFrame, dims: DataFrame, passes: range, window: int, least: float, seed: int) -> DataFrame:
    """Links (a, b) of classes that connect what the windows of these passes link; a = b: a probe that found a link."""
    placed = _sorted_blocks(base, dims, passes, window, least, seed)
    group, first = F.expr(f"at div {SPAN}"), F.col("at") % SPAN == 0
    # the first block of a group is also what the last block of the group before is compared with
    spread = placed.withColumn("group", F.explode(F.when(first & (F.col("at") > 0), F.array(group - 1, group)).otherwise(F.array(group))))

    def link(part: pa.Table) -> pa.Table:
        at, probe = part["at"].to_numpy(), part["probe"].to_numpy(zero_copy_only=False).astype(bool)
        name, raw = part["class"].to_pylist(), part["vec"].to_pylist()
        x, found = _unit(raw, len(raw[0]) // 8), []
        low = part["group"][0].as_py() * SPAN
        for k in range(low, low + SPAN):
            here, after = np.flatnonzero((at == k) & ~probe), np.flatnonzero((at == k + 1) & ~probe)
            found += _connecting(x, here, here, least) + _connecting(x, here, after, least)
        for k in range(low, low + SPAN + 1):
            asked = np.flatnonzero((at == k) & probe)
            near = np.flatnonzero((np.abs(at - k) <= 1) & ~probe)
            for lo in range(0, len(asked) if len(near) else 0, 256):
                hit = (x[asked[lo:lo + 256]] @ x[near].T >= least - 1e-9).any(1)
                found += [(i, i) for i in asked[lo:lo + 256][hit].tolist()]
        return pa.table({"a": pa.array([name[i] for i, _ in found], pa.binary()), "b": pa.array([name[j] for _, j in found], pa.binary())})

    return stored(spread.groupBy("dim", "pass", "group").applyInArrow(link, "a binary, b binary"), "links")


def near_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                 block: int = BLOCK, window: int = WINDOW, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
                  .mapInArrow(_bytes_of, "vec_id long, vec binary")
                  .withColumn("class", F.when(F.col("vec").isNotNull(), F.unhex(F.md5("vec")))), "vectors")
    full = rows.where("vec is not null")
    classes = stored(full.groupBy("class", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
                     .withColumn("dim", (F.octet_length("vec") / 8).cast("int")), "classes")

    dims = stored(classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")), "dims")
    asked = by_key(classes.select("dim", "class", "vec"), dims, "dim").where(
        F.pmod(F.xxhash64("class"), F.greatest(F.lit(1), F.expr(f"n div {PROBES}"))) == 0)
    probes = stored(asked.select("dim", "class", "vec").mapInArrow(
        lambda batches: _partners(batches, least, seed), "dim int, class binary, vec binary"), "probes")
    base = (classes.select("dim", "class", "vec", F.lit(False).alias("probe"))
            .unionByName(probes.withColumn("probe", F.lit(True))))
    links, passes = None, range(0, 1)
    while True:
        more = _linked(base, dims, passes, window, least, seed)
        links = more if links is None else links.unionByName(more)
        hit = links.where("a = b").select(F.col("a").alias("class")).distinct().withColumn("hit", F.lit(1.0))
        recall = (by_key(probes.select("dim", "class"), hit, "class", "left").groupBy("dim")
                  .agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("r")).agg(F.min("r")).first()[0])
        let_go(vectors.sparkSession)
        if recall is None or recall >= 1 - MISS:
            break
        passes = range(passes.stop, passes.stop + ROUND)
    groups = components(links)
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("g"))
    member = by_key(by_key(groups.withColumnRenamed("id", "class"), classes.select("class", "rep", "m", "vec"), "class"),
                    sizes, "root")

    def count(group: pa.Table) -> pa.Table:
        own = group["own"].to_numpy()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        name, raw = group["class"].to_pylist(), group["vec"].to_pylist()
        x, m = _unit(raw, len(raw[0]) // 8), group["m"].to_numpy()
        total = np.zeros(len(x), np.int64)
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        for lo in range(0, len(a), 256):
            part = a[lo:lo + 256]
            near = x[part] @ x[b].T >= least
            if i == j:
                near[np.arange(len(part)), lo + np.arange(len(part))] = False  # not itself
                total[part] += near @ m[b]
            else:
                total[part] += near @ m[b]
                total[b] += m[part] @ near
        return pa.table({"class": pa.array(name, pa.binary()), "links": pa.array(total)})

    linked = (in_blocks(member, block).groupBy("root", "i", "j").applyInArrow(count, "class binary, links long")
              .groupBy("class").agg(F.sum("links").alias("links")))
    smallest = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    rooted = by_key(member.select("root", "class"), smallest, "root").select("class", "component_id")
    known = by_key(by_key(classes.select("class", "rep", "m"), linked, "class", "left"), rooted, "class", "left").select(
        "class", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"))
    out = by_key(full.select("vec_id", "class"), known, "class").select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                           F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@register("op4_sorted_projections", """
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
g AS (SELECT vec_id, v FROM e WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM e UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT c.x AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, c.x = component_id AS kept
FROM c LEFT JOIN n ON n.x = c.x""")
def op4_sorted_projections(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
