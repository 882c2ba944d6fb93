"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors can read: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, local mode gets a folder of its own, deleted at the end; a cluster has none that all machines share.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="wikiloom-")
        atexit.register(shutil.rmtree, _own_dir[app], ignore_errors=True)
    return _own_dir[app]


def stage(df: DataFrame, name: str, measure: Column | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the lineage and survives lost executors.

    With ``measure``, an aggregate that is taken while the rows are written, the result has it as ``_measured``.
    """
    spark, seen = df.sparkSession, Observation()
    df = df if measure is None else df.observe(seen, measure.alias("m"))
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if measure is not None:
        out._measured = seen.get["m"]
    return out


def drop(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` wrote and that nothing reads any more."""
    for df in staged:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(conf).delete(path, True)


def unstage(*staged: DataFrame) -> None:
    """``drop``, and let go of the shuffles that made the tables."""
    drop(*staged)
    # The listeners of a query hold it for a moment after its end.
    for _ in range(3):
        gc.collect()
        SparkSession.active()._jvm.System.gc()
        time.sleep(0.5)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-side table as a JVM literal (no RDD, no Python workers)."""
    import json

    names = [f.name for f in T._parse_datatype_string(schema).fields]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def fan_out(rows: int) -> int:
    """Into how many pieces a key that may hold all ``rows`` is cut: about a million rows each, 64 at least."""
    return max(64, rows >> 20)


def ranked(df: DataFrame, keys: list[str], order: list[Column], spread: Column, out: str, fan: int = 64) -> DataFrame:
    """Adds ``out``: the 0-based position of each row among the rows of its ``keys``.

    Each key is cut into ``fan`` pieces by ``spread`` (a long), so a key that holds a third of all rows is ranked by
    many tasks: row numbers inside a piece, plus the sizes of the pieces before it. ``df`` is read twice; stage it first.
    """
    df = df.withColumn("_piece", F.pmod(spread, F.lit(fan)).cast("int"))
    sizes = df.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    rows = df.withColumn("_in", F.row_number().over(inside) - 1)
    return rows.join(sizes, [*keys, "_piece"]).withColumn(out, F.col("_before") + F.col("_in")).drop("_piece", "_before", "_in")


#: Keys with more than this share of the rows are hot; there are fewer of them than its inverse.
HOT_KEYS = 4096


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, how: str = "inner", n_keys: int | None = None) -> DataFrame:
    """``rows`` joined (inner or left) to ``table`` on ``keys``, which are unique and not null there; column ``count`` says how many rows have a key.

    The table's hot keys, fewer than HOT_KEYS whatever the input, are broadcast; only rows of other keys are shuffled, so no
    task gets more than a small share of them. ``rows`` is read twice; stage it first. A table known to have few enough
    keys (``n_keys``) is broadcast as a whole. Rows with a null key match nothing and stay where they are.
    """
    if n_keys is not None and n_keys <= HOT_KEYS:
        return rows.join(F.broadcast(table), keys, how)
    least = max(1, total // HOT_KEYS)
    hot = table.where(F.col(count) > least).withColumn("_hot", F.lit(True))
    met = rows.join(F.broadcast(hot), keys, "left")
    keyless = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    done = met.where(F.col("_hot").isNotNull() | keyless) if how == "left" else met.where("_hot")
    cold = met.where(F.col("_hot").isNull() & ~keyless).select(*rows.columns).join(table.where(F.col(count) <= least), keys, how)
    return done.drop("_hot").unionByName(cold)


def numbered(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """Staged ``df`` with ``out``: the 0-based place of each row in the order over all rows.

    The rows are sorted by range over all partitions; the table of the partitions' sizes, one row each, is what is added up.
    """
    rows = stage(df.orderBy(*order).withColumn("_i", F.monotonically_increasing_id()), name).withColumn("_part", F.shiftright("_i", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + F.col("_i").bitwiseAND((1 << 33) - 1)).drop("_i", "_part", "_start")


def reads_alike(df: DataFrame) -> bool:
    """Whether each reading of ``df`` gives the same rows in the same partitions and order: it does no more than scan files."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() not in ("Project", "Filter", "LogicalRelation", "Relation"):
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges``, for each node that has an edge.

    Alternating large-star and small-star steps; every step groups by node with map-side minima and joins them back with hubs
    apart (``join_counted``), and every round is written to the shared folder in place of the round before. Nothing is
    collected but counts of edges and a checksum.
    """

    def lowest(e: DataFrame, total: int) -> DataFrame:
        return join_counted(e, e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_c")), ["u"], "_c", total, n_keys=total)

    n = F.count(F.lit(1))
    e = stage(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc", F.struct(n.alias("n")))
    seen, total = None, e._measured.n
    while total:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lowest(both, 2 * total).withColumn("m", F.least("m", "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stage(large.distinct(), "cc", n)
        met = lowest(large, large._measured)
        small = met.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").unionByName(met.select("u", F.col("m").alias("v")))
        new = stage(small.distinct(), "cc", F.struct(n.alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash")))
        drop(e, large)
        e, now = new, new._measured
        if now == seen:
            break
        seen, total = now, now.n
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
