"""Sources and sinks: TSV records, ground truth, id lists, JSON and CSV reports, stage checkpoints."""

from __future__ import annotations

import gc
import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORDS = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def read_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A TSV source with a declared schema; only empty fields are null."""
    df = spark.read.schema(RECORDS).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return df.limit(limit) if limit is not None else df


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(TRUTH).option("sep", "\t").option("header", True).csv(path)
    return df.withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.lit("")))


def parse_ids(ids: Column) -> Column:
    """Distinct ids of a comma list; none for null or blank."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))


def explode_truth(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, other_entity_id); entities without matches leave no row."""
    return truth.select("source1_entity_id", F.explode(parse_ids(F.col("matched_entity_ids"))).alias("other_entity_id"))


def of_source(pairs: DataFrame, number: int, column: str = "other_entity_id") -> DataFrame:
    """The rows whose id, without blanks around it, belongs to source ``number`` by its prefix."""
    return pairs.where(F.trim(column).startswith(f"S{number}-"))


def id_lists(entities: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row per entity of entities(source1_entity_id): its distinct partners, sorted, as a comma list, '' if none."""
    lists = pairs.groupBy("source1_entity_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("other_entity_id"))).alias(column))
    return entities.select("source1_entity_id").join(lists, "source1_entity_id", "left").withColumn(column, F.coalesce(column, F.lit("")))


def write_id_lists(lists: DataFrame, path: str) -> None:
    lists.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def read_id_lists(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(source1_entity_id, <column>, n): with the length of each list."""
    schema = f"source1_entity_id string, `{column}` string"
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
    return df.withColumn(column, F.coalesce(column, F.lit(""))).withColumn("n", F.size(parse_ids(F.col(column))))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


_local: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the session names in spark.checkpoint.dir; a temporary folder takes its place on a local master only."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not top:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
        top = _local[0]
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once below the shared folder: what follows reads it as often as it likes, and lost executors lose nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rest(spark: SparkSession, executors: bool = False) -> None:
    """Called between stages: the driver gives the heap that plans have filled back to the system, and Spark's cleaner sees which shuffles are no longer needed.

    executors: they do so too, by a task for each core, and keep no heap that an earlier stage has needed.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if executors:
        cores = spark.sparkContext.defaultParallelism
        spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


class Checkpoints:
    """Stage results as Parquet below a folder; a stage counts as done once its _SUCCESS marker stands.

    key: what the results depend on besides their names (configuration, inputs); each key has a folder of its own.
    """

    def __init__(self, spark: SparkSession, folder: str, key: object = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        if key is not None:
            self.folder += "/" + hashlib.sha256(repr(key).encode()).hexdigest()[:16]

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def has(self, stage: str) -> bool:
        store, path = self._fs(f"{self.folder}/{stage}/_SUCCESS")
        return store.exists(path)

    def mark(self, stage: str) -> None:
        """Tells that a stage that writes its own files has written all of them."""
        store, path = self._fs(f"{self.folder}/{stage}/_DONE")
        store.create(path, True).close()

    def marked(self, stage: str) -> bool:
        store, path = self._fs(f"{self.folder}/{stage}/_DONE")
        return store.exists(path)

    def put(self, stage: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{stage}")
        return self.get(stage)

    def get(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{stage}")

    def stage(self, stage: str, make: Callable[[], DataFrame], large: bool = False) -> DataFrame:
        """The stage's table, made only if it isn't there; executors rest after a large one."""
        if self.has(stage):
            return self.get(stage)
        table = self.put(stage, make())
        rest(self.spark, large)
        return table

    def drop(self, stage: str) -> None:
        """Deletes a stage that no later one reads."""
        store, path = self._fs(f"{self.folder}/{stage}")
        store.delete(path, True)

    def clear(self) -> None:
        store, path = self._fs(self.folder)
        store.delete(path, True)
