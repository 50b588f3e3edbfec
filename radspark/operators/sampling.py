"""Splits, shards, batches and weighted samples, deterministic on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from radspark.storage import spool

TRAIN, VALIDATION = 0.70, 0.15


def hash_uniform(key: Column, seed: str | int) -> Column:
    """A number in [0, 1) from a key and a seed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def split_of(key: Column, seed: int = 42, train: float = TRAIN, validation: float = VALIDATION) -> Column:
    """train, val or test by a hash of the key: all rows of a patient fall together, without a shuffle."""
    u = hash_uniform(key, seed)
    return F.when(u < train, "train").when(u < train + validation, "val").otherwise("test")


def global_index(df: DataFrame, *order: str) -> DataFrame:
    """``index``: place in the global order, from 0.

    Range partitioning sorts in parallel; only one count per partition is
    gathered, so no task sees all rows. The numbered rows are written once,
    for range bounds are sampled and a second pass could place rows otherwise.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    own = spool(laid.withColumn("__row", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33)))
    sizes = own.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row per partition
    return own.join(F.broadcast(before.select("__part", "__before")), "__part").withColumn("index", F.col("__row") + F.col("__before")).drop("__part", "__row", "__before")


def shards_by_count(df: DataFrame, per_shard: int, *order: str) -> DataFrame:
    """``shard``: consecutive runs of ``per_shard`` rows in order."""
    return global_index(df, *order).withColumn("shard", F.floor(F.col("index") / per_shard).cast("int")).drop("index")


def shards_of_workers(shards: DataFrame, workers: int, *order: str) -> DataFrame:
    """``worker``: shards dealt out in turn."""
    return global_index(shards, *order).withColumn("worker", F.pmod(F.col("index"), F.lit(workers)).cast("int")).drop("index")


def batches(df: DataFrame, size: int, value: str, *order: str, drop_last: bool = True) -> DataFrame:
    """batch, n, items: ``size`` rows each, in order; a short last batch goes if asked."""
    at = global_index(df.select(value, *[c for c in order if c != value]), *order)
    made = at.groupBy(F.floor(F.col("index") / size).cast("int").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("index", F.col(value).alias("v")))), lambda x: x["v"]).alias("items"))  # size items at most
    return made.where(F.col("n") == size) if drop_last else made


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, n, weight (total over the class's count)."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select(label, "n", (F.col("total") / F.col("n")).alias("weight"))  # total: one row


def balanced_draws(df: DataFrame, label: str, key: str, draws: int, seed: int = 42) -> DataFrame:
    """``draws`` rows drawn with replacement, every class alike: draw, key, label.

    A draw picks a class by one hash and a row of it by another; rows are
    numbered within their class by partition counts, so no class is gathered.
    """
    rows = global_index(df.select(label, key), label, key)
    first = rows.groupBy(label).agg(F.min("index").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = global_index(first, label).withColumnRenamed("index", "class_no")
    k = classes.agg(F.count(F.lit(1)).alias("classes"))
    d = df.sparkSession.range(draws).withColumnRenamed("id", "draw").join(F.broadcast(k))  # one row
    d = d.withColumn("class_no", F.floor(hash_uniform(F.col("draw"), f"{seed}c") * F.col("classes")))
    d = d.join(classes, "class_no").withColumn("index", F.col("first") + F.floor(hash_uniform(F.col("draw"), f"{seed}r") * F.col("n")))
    return d.select("draw", "index").join(rows, "index").select("draw", key, label)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """All rows in a random order that the seed fixes."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(k)
