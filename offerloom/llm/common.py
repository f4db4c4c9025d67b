"""Shared helpers: intermediate tables, distributed ranks and connected components."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from offerloom.functions.names import fresh  # noqa: F401  for the other modules of this package
from offerloom.sources.scratch import new_path, remove


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so later jobs start from files that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`materialize` wrote, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Set the session to hand texts to Python in batches of so many rows: what a task holds beside them is a tenth of Spark's default."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def tidy(run):
    """``run`` (batches in, batches out), which at its end gives free memory back: a worker process outlives its task."""

    def wrapped(batches):
        yield from run(batches)
        release_memory()

    return wrapped


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


#: Bits of a filter on ids: 2 MB, whatever the number of ids. Beyond some million ids it lets through more than it should.
FILTER_BITS = 1 << 24


def bit_filter(slots: DataFrame, column: str) -> bytes:
    """A bit for each value of ``column`` (0 to FILTER_BITS - 1) that occurs."""
    slot = F.col(column)
    rows = slots.select(F.floor(slot / 32768).alias("b"), (slot % 32768).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    out = bytearray(FILTER_BITS // 8)
    for r in rows:
        out[r.b * 4096 : (r.b + 1) * 4096] = r.bits
    return bytes(out)


def strata(n0: int, n1: int, most: int) -> tuple[int, int]:
    """Rows to take of two kinds with n0 and n1 rows: ``most`` at most, half of each kind, and more of one if the other has fewer."""
    k1 = min(n1, max(most // 2, most - n0))
    return min(n0, most - k1), k1


def distributed_rank(df: DataFrame, group: str, order: list[str], rank: str, rows_per_bucket: int = 50_000, ranges: str | None = None) -> DataFrame:
    """Add ``rank`` (0, 1, ...) within ``group`` without sorting a whole group in one task.

    Rows of a group are dealt into buckets by a hash of the order columns, or by equal parts of the span of ``ranges`` (a column of
    numbers that are spread about evenly); ranks run through bucket after bucket and, inside a bucket, by the order columns. There are as many buckets as shuffle partitions, and more once a bucket would exceed ``rows_per_bucket``
    rows, so a group that holds a third of all rows is spread evenly. Rows that agree in all order columns get different ranks, in any order.
    """
    found = df.agg(F.count(F.lit(1)).alias("n"), *([F.min(ranges).alias("low"), F.max(ranges).alias("high")] if ranges else [])).first()
    n_buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-found.n // rows_per_bucket))
    b, first = fresh(df, "bucket_", "first_")
    bucket = F.pmod(F.xxhash64(*order), F.lit(n_buckets))
    if ranges and found.n:
        bucket = F.floor((F.col(ranges).cast("double") - float(found.low)) / ((found.high - found.low) / n_buckets + 1))
    spread = df.withColumn(b, bucket.cast("int"))
    sizes = spread.groupBy(group, b).agg(F.count(F.lit(1)).alias(first))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("g_"), F.col(b).alias("b_"), F.coalesce(F.sum(first).over(before), F.lit(0)).alias(first))
    joined = spread.join(starts, F.col(group).eqNullSafe(F.col("g_")) & (F.col(b) == F.col("b_")), "left").drop("g_", "b_")
    within = Window.partitionBy(group, b).orderBy(*order)
    return joined.withColumn(rank, (F.col(first) + F.row_number().over(within) - 1).cast("long")).drop(b, first)


def join_by_frequency(rows: DataFrame, table: DataFrame, key: str, count: str, often: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``table`` (a written table with one row for each ``key`` of ``rows`` and its ``count``); null keys match.

    Keys with more than one in ``often`` rows, fewer than ``often`` of them, are broadcast; the other rows meet theirs by a shuffle, in
    which no key is frequent.
    """
    (other,) = fresh(rows, "key_")
    table = table.withColumnRenamed(key, other)
    n = table.agg(F.sum(count)).first()[0] or 0
    frequent, same = F.col(count) * often > n, F.col(key).eqNullSafe(F.col(other))
    hot = F.broadcast(table.where(frequent))
    rare = rows.join(hot, same, "left_anti").join(table.where(~frequent), same)
    return rows.join(hot, same).unionByName(rare).drop(other, count)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) and, for each, the smallest node it is connected to."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = idx[: len(a)], idx[len(a) :]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, low[i], m)
        np.minimum.at(new, low[j], m)
        new = new[new]
        if np.array_equal(new, low):
            return nodes, nodes[low]
        low = new


EDGE = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _contract(batches):
    """Per partition: replace the links by stars onto the smallest node, batch by batch (memory: the partition's nodes)."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        nodes, low = forest(np.concatenate([a, u]), np.concatenate([b, v]))
        keep = nodes != low
        a, b = nodes[keep], low[keep]
    for k in range(0, len(a), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[k : k + 50_000]), pa.array(b[k : k + 50_000])], names=["u", "v"])


def connected_components(edges: DataFrame, max_rounds: int = 40, few: int = 500_000) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (columns u, v: long).

    Each partition first contracts its own links to stars. If ``few`` links are left at most (a checked 8 MB), one task finishes
    them; beyond, large-star and small-star rounds alternate until the links form
    stars. Minimum neighbours are pre-aggregated before each shuffle, so a hub with very many links is one row per task; the join
    that follows is one that AQE can split. Each round is written to the shared folder, which cuts the lineage.
    """
    e = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    e = materialize(e.mapInArrow(_contract, EDGE), "links")  # u > v: stars of each partition
    if e.count() <= few:
        e = materialize(e.coalesce(1).mapInArrow(_contract, EDGE), "links")
        roots = e.select(F.col("v").alias("node")).distinct()
        return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    for _ in range(max_rounds):
        parents = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        loose = parents.where("n > 1").select("u").unionByName(e.select(F.col("v").alias("u")).join(parents.select("u"), "u", "left_semi"))
        if loose.isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        e = materialize(small.where("u <> v").distinct().mapInArrow(_contract, EDGE).distinct(), "links")
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
