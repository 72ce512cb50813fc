"""Keyed merges: attempts into attempts, assignments into ledgers, histories, positional joins, single-writer sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.operators.compare import scrubbed_json
from sievework.sources.sinks import swap, write_checked


def attempt_key(timestamp: Column, solution: Column) -> Column:
    """Two attempts with the same timestamp and first 500 characters are one; without either there is no key."""
    return F.when(timestamp.isNotNull(), F.xxhash64(timestamp, F.coalesce(F.left(solution, F.lit(500)), F.lit(""))))


def merge_attempts(base: DataFrame, incoming: DataFrame, keys: Sequence[str], timestamp: str, solution: str, order: str) -> DataFrame:
    """Base rows updated by incoming ones field by field (incoming wins where it has a value), the rest appended.

    The n-th incoming row of a key meets the n-th base row of it, so one base row is used
    once. Rows without a key are appended. ``merged_from``: base, incoming or both.
    """

    def ready(df: DataFrame, side: str) -> DataFrame:
        keyed = df.withColumn("_key", attempt_key(F.col(timestamp), F.col(solution)))
        lone = F.when(F.col("_key").isNull(), F.concat(F.lit(side), F.col(order).cast("string")))
        place = F.row_number().over(Window.partitionBy(*keys, "_key", lone).orderBy(order))
        return keyed.withColumn("_lone", F.coalesce(lone, F.lit(""))).withColumn("_nth", place).withColumn("_key", F.coalesce("_key", F.lit(0)))

    on = [*keys, "_key", "_lone", "_nth"]
    rest = [c for c in base.columns if c not in keys]
    left, right = ready(base, "b"), ready(incoming, "i")
    both = left.select(*on, F.struct(*rest).alias("_b")).join(right.select(*on, F.struct(*rest).alias("_i")), on, "full_outer")
    origin = F.when(F.col("_b").isNull(), "incoming").when(F.col("_i").isNull(), "base").otherwise("both")
    return both.select(*keys, *(F.coalesce(F.col(f"_i.{c}"), F.col(f"_b.{c}")).alias(c) for c in rest), origin.alias("merged_from"))


def merge_assignment(ledger: DataFrame, new: DataFrame, topic: str, number: str) -> DataFrame:
    """Ledgers of (topic, number) as one, each pair once."""
    return ledger.select(topic, number).unionByName(new.select(topic, number)).distinct()


def ledger_documents(ledger: DataFrame, topic: str, number: str) -> DataFrame:
    """topic -> sorted list of numbers, as the document form of a ledger."""
    return ledger.groupBy(topic).agg(F.sort_array(F.collect_set(number)).alias("problems"))


def push_history(cases: str = "test_cases", history: str = "previous_test_cases_history") -> Column:
    """The history array with the present cases appended; unchanged without any."""
    return F.when(F.size(F.col(cases)) > 0, F.array_append(F.coalesce(F.col(history), F.array()), F.col(cases))).otherwise(F.col(history))


def zipped(*arrays: Column) -> Column:
    """Arrays joined by position, as long as the shortest."""
    return F.slice(F.arrays_zip(*arrays), 1, F.least(*(F.coalesce(F.size(a), F.lit(0)) for a in arrays)) if len(arrays) > 1 else F.size(arrays[0]))


def attach_verdicts(attempts: DataFrame, results: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Each key's first result by ``order`` goes to the first attempt of the key; attempts without one keep what they have."""
    once = results.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias("_new"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1
    joined = attempts.withColumn("_first", first).join(once, list(keys), "left")
    old = F.col(value) if value in attempts.columns else F.lit(None).cast(results.schema[value].dataType)
    return joined.withColumn(value, F.when(F.col("_first"), F.coalesce("_new", old)).otherwise(old)).drop("_first", "_new")


def same_keys(a: Column, b: Column) -> Column:
    """Whether two maps have the same keys."""
    return (F.size(F.array_except(F.map_keys(a), F.map_keys(b))) == 0) & (F.size(F.array_except(F.map_keys(b), F.map_keys(a))) == 0)


def rewrite(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Replaces a table by ``new`` (which may read it): written beside it first, then swapped by renames."""
    new.write.mode("overwrite").parquet(path + ".new")
    swap(spark, path + ".new", path)


def save_merged(spark: SparkSession, path: str, incoming: DataFrame, key: str, scrub: Sequence[str] = ()) -> None:
    """Updates a table of documents: fields of ``incoming`` win where they have a value, new documents are added.

    ``scrub`` names JSON columns whose values that are not finite become null. Single writer: the
    new table is written beside the old one, read back and swapped in.
    """
    ready = incoming.select(*(scrubbed_json(c).alias(c) if c in scrub else F.col(c) for c in incoming.columns))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        base = spark.read.parquet(path)
        rest = [c for c in base.columns if c != key]
        both = base.alias("b").join(ready.alias("i"), key, "full_outer")
        ready = both.select(key, *(F.coalesce(F.col(f"i.{c}"), F.col(f"b.{c}")).alias(c) if c in ready.columns else F.col(f"b.{c}").alias(c) for c in rest))
    write_checked(ready, path)


def append_log(log: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Appends to a log table; with ``keys`` each key is logged once, whatever the log holds already."""
    spark = log.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if keys:
        log = log.dropDuplicates(list(keys))
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            log = log.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    log.write.mode("append").parquet(path)
