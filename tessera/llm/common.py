"""What the operators share: scratch tables, size-checked broadcasts and connected components.

Scratch tables are written under the folder that the session names in
``spark.checkpoint.dir``; executors can be lost at any time, and a written
table outlives them.  Where the setting is absent, a temporary folder takes its
place on a local master (tests, notebooks); on a cluster that is an error.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a broadcast side may have; more than that goes by a shuffle join.
BROADCAST_ROWS = 1_000_000
#: Bytes that it may have.
BROADCAST_BYTES = 128 << 20
#: Edges whose components one task finds, in some 100 MB.
ONE_TASK = 500_000

#: Java form of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"

_own_dir: list[str] = []

#: Of a Python worker: what forgets the words that an operator has cached, and the operator that caches now.
_forget: dict[str, Callable[[], None]] = {}
_caching: list[str] = [""]


def claim(owner: str, forget: Callable[[], None]) -> None:
    """Called by tasks that cache words: a worker lives on from stage to stage, and keeps one operator's cache at a time."""
    if _caching[0] != owner:
        _forget.get(_caching[0], lambda: None)()
        _caching[0], _forget[owner] = owner, forget
        release()


def release() -> None:
    """Called at the end of tasks: gives freed memory back to the system, as an idle worker would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
    return _own_dir[0]


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Limits Arrow batches of the session by bytes, unless a limit as low is set: rows of long texts would make them huge."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) > size:
        spark.conf.set(key, str(size))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df once and returns the written table: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def drop_tables(*tables: DataFrame, clean: bool = False) -> None:
    """Deletes tables of materialize() that nothing reads any more; with clean, lets Spark's cleaner see which shuffles are no longer needed, and rests the executors."""
    for t in tables:
        spark, path = t.sparkSession, _written.pop(t)
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if clean:
        gc.collect()
        SparkSession.active().sparkContext._jvm.System.gc()
        rest(SparkSession.active())


def rest(spark: SparkSession) -> int:
    """Called between stages: executors collect their garbage and give heap back to the system, as they would otherwise keep all that any stage has ever needed.

    A task for each core; returns their number.
    """
    cores = spark.sparkContext.defaultParallelism
    return len(spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect())


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if at most ``rows`` rows and ``size`` bytes are found; df itself otherwise.

    df should be a written table, as it is counted and measured here: strings, binaries and arrays by their length, other values as 8 bytes.
    """
    def width(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 8
        if isinstance(kind, T.ArrayType):
            return 8 + F.greatest(F.size(name), F.lit(0)) * (32 if isinstance(kind.elementType, T.StructType) else 16)
        return F.lit(8 if not isinstance(kind, T.StructType) else 32)

    each = sum((width(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(each.cast("long")), F.lit(0)).alias("w")).first()
    return F.broadcast(df) if found.n <= rows and found.w <= size else df


def key_part(c: Column) -> Column:
    """A group key in which null is a value of its own."""
    return F.struct(c.isNull().alias("none"), F.coalesce(c.cast("string"), F.lit("")).alias("value"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components (node, component) of all edges (u, v) of a task, by union-find."""
    parts = [*batches]
    u, v = (np.concatenate([np.empty(0, np.int64), *(b.column(k).to_numpy() for b in parts)]) for k in (0, 1))
    names, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    parent = list(range(len(names)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(at[: len(u)].tolist(), at[len(u) :].tolist(), strict=True):
        x, y = top(x), top(y)
        parent[max(x, y)] = min(x, y)  # names are sorted, so the least name is on top
    tops = np.fromiter(map(top, range(len(names))), np.int64, len(names))
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[tops])], names=["node", "component"])


def components(edges: DataFrame, name: str = "components", one_task: int = ONE_TASK) -> DataFrame:
    """Connected components of edges(a, b): a written table with one row (node, component) for each node, component its smallest node.

    Up to ``one_task`` distinct edges (counted) are joined in one task.  More of them
    alternate large-star and small-star steps.  Each step takes the least
    neighbour by a pre-aggregated min and joins it back, so a hub with any
    number of edges costs no more than its edges; a skewed join side is split
    by adaptive execution.  Ends when the edges are stars.  Nulls and loops
    are ignored.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(pairs, f"{name}-edges")
    if edges.count() <= one_task:
        found = materialize(edges.coalesce(1).mapInArrow(_joined, "node bigint, component bigint"), name)
        drop_tables(edges)
        return found
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        last, edges = edges, materialize(small_star, f"{name}-edges")
        drop_tables(last)
        # Stars keep what is connected together, so the labels are final once each node has one edge and no root has any.
        ends = edges.select("u", F.lit(0).alias("root")).union(edges.select(F.col("v").alias("u"), F.lit(1).alias("root")).distinct())
        if not ends.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), name)
    drop_tables(edges)
    return found
