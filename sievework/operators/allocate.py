"""Allocation of work: shares to counts, topics to ids, workers, resuming, limits, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def level_counts(levels: DataFrame, total: int, ratio: str = "ratio", order: str = "level_ord") -> DataFrame:
    """``n`` per level by largest remainder: floors first, what is left to the greatest remainders, earlier levels on ties.

    Ratios are normalised; equal where they sum to nothing. ``levels`` is a short driver-made list.
    """
    whole = Window.partitionBy()
    weight = F.when(F.sum(ratio).over(whole) > 0, F.col(ratio) / F.sum(ratio).over(whole)).otherwise(1.0 / F.count(F.lit(1)).over(whole))
    exact = levels.withColumn("_x", weight * total)
    floors = exact.withColumn("_f", F.floor("_x")).withColumn("_r", F.col("_x") - F.col("_f"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("_r"), F.asc(order)))
    left = F.lit(total) - F.sum("_f").over(whole)
    return floors.withColumn("_k", rank).withColumn("n", (F.col("_f") + (F.col("_k") <= left).cast("int")).cast("bigint")).drop("_x", "_f", "_r", "_k")


def distribute(counts: DataFrame, topics: DataFrame, level: str, level_order: str, topic: str, topic_order: str, start: int = 1) -> DataFrame:
    """(level, topic, problem_no): topics of a level in turn, numbers on through the levels in order.

    A level without topics loses its count; ids follow level order, then turn.
    """
    ranked = topics.withColumn("_slot", F.row_number().over(Window.partitionBy(level).orderBy(topic_order)) - 1).withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(level)))
    # each turn meets its own topic only; levels without topics drop out here
    sized = counts.where("n > 0").join(ranked.where("_slot = 0").select(level, "_size"), level)
    turns = sized.select(level, level_order, "_size", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("_turn"))
    placed = turns.withColumn("_slot", F.pmod("_turn", "_size").cast("int")).join(ranked.select(level, topic, "_slot"), [level, "_slot"])
    return numbered(placed, [level_order, "_turn"], "problem_no", start).select(level, topic, "problem_no")


def assign_requested(requested: DataFrame, assigned: DataFrame, topic: str, order: str, start: int = 1) -> DataFrame:
    """One number per requested topic that has none, on from ``start``."""
    new = requested.join(assigned.select(topic).distinct(), topic, "left_anti")
    return numbered(new, [order], "problem_no", start).select(topic, "problem_no")


def unknown_ids(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requested ids that are not known; must be empty before work begins."""
    return requested.select(key).distinct().join(known.select(key), key, "left_anti")


def remaining(assignment: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Assigned work that no result exists for."""
    return assignment.join(done.select(key), key, "left_anti")


def totals(assignment: DataFrame, key: str, target: int) -> DataFrame:
    """assigned, next_id and to_add of a ledger."""
    got = assignment.agg(F.count_distinct(key).alias("assigned"), (F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias("next_id"))
    return got.withColumn("to_add", F.greatest(F.lit(target) - F.col("assigned"), F.lit(0)).cast("bigint"))


def preview(df: DataFrame, key: str, rows: int = 5, seed: int = 1) -> DataFrame:
    """A few rows to look at, the same on every run: by a hash of seed and key."""
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return df.withColumn("_h", drawn).orderBy("_h", key).limit(rows).drop("_h")


def first_match(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Inner join on the first row of ``right`` per key; rows without a match are left out."""
    others = [c for c in right.columns if c != key]
    once = right.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")
    return left.join(once, key)


def workers(items: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Item i goes to worker i mod n, in order.

    The number of a row comes from a range sort: counts of its partitions (a row each) give
    the offsets, so no task orders everything.
    """
    return numbered(items, order, "item_no").withColumn("worker", F.pmod(F.col("item_no"), F.lit(n)).cast("bigint"))


def numbered(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``name``: each row's place in the order, from ``start``; without one task holding all rows."""
    ranged = df.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_p", F.spark_partition_id())
    inside = Window.partitionBy("_p").orderBy(*order)
    ranked = tagged.withColumn("_i", F.row_number().over(inside))
    sizes = ranked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return ranked.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_o") + F.col("_i") - 1 + start).cast("bigint")).drop("_p", "_i", "_o")


def split(df: DataFrame, key: str, ratio: float = 0.8, val_size: int | None = None, seed: int = 42) -> DataFrame:
    """``part`` train or val with exact sizes: by rank of a hash of seed and key.

    int(rows x ratio) rows train, or val_size rows (at most all) validate.
    """
    total = df.count()
    val = min(val_size, total) if val_size is not None else total - int(total * ratio)
    drawn = df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))))
    ranked = numbered(drawn, ["_h", key], "_k")
    return ranked.withColumn("part", F.when(F.col("_k") < total - val, "train").otherwise("val")).drop("_h", "_k")


def weighted_draws(weights: DataFrame, draws: DataFrame, key: str, weight: str, seed: int = 7) -> DataFrame:
    """``key`` for each row of ``draws``: chosen with probability in proportion to weight.

    ``weights`` is a short list (levels, topics): its cumulative ranges are broadcast. Weights that are
    null or not positive are never drawn.
    """
    good = weights.where(F.col(weight) > 0)
    share = F.sum(weight).over(Window.partitionBy().orderBy(key)) / F.sum(weight).over(Window.partitionBy())
    ranges = good.select(share.alias("_hi"), F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct("_hi", "_k"))).alias("_r"))
    # the first 52 bits of a hash of seed and row
    drawn = F.md5(F.concat_ws(":", F.lit(seed), *(F.col(c).cast("string") for c in draws.columns)))
    u = F.conv(F.left(drawn, F.lit(13)), 16, 10).cast("double") / F.lit(float(2**52))
    picked = F.try_element_at(F.filter("_r", lambda r: r["_hi"] > F.col("_u")), F.lit(1))["_k"]
    # one row with the list of ranges: a scalar, not a cross join of rows
    return draws.withColumn("_u", u).join(F.broadcast(ranges), F.lit(True)).withColumn(key, picked).drop("_u", "_r")


def previous(df: DataFrame, by: str, order: Sequence[str], value: str) -> Column:
    """The list of earlier non-empty values of the group, in order (the running context of a topic).

    Lists grow with the group: for the few rows that are due, after ``latest_before`` has
    told how much context there is; not for a whole table.
    """
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.collect_list(F.when(F.length(F.trim(F.col(value))) > 0, F.col(value))).over(w)


def before(df: DataFrame, by: str, order: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``earlier`` and ``last_earlier``: how many non-empty values of its group come before a row, and the last of them.

    Rows are sorted by (group, order) in ranges, so a group of a third of all rows spreads over
    many tasks; a row per range and group carries counts and last values from range to range.
    """
    ranged = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order).withColumn("_p", F.spark_partition_id())
    full = F.when(F.length(F.trim(F.col(value))) > 0, F.col(value))
    inside = Window.partitionBy("_p", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("_n", F.count(full).over(inside)).withColumn("_l", F.last(full, ignorenulls=True).over(inside))
    ends = ranged.groupBy("_p", by).agg(F.count(full).alias("_c"), F.max_by(full, F.when(full.isNotNull(), F.struct(*order))).alias("_e"))
    over = Window.partitionBy(by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_p", by, F.coalesce(F.sum("_c").over(over), F.lit(0)).alias("_before"), F.last("_e", ignorenulls=True).over(over).alias("_from"))
    same = carried.withColumnRenamed(by, "_g").withColumnRenamed("_p", "_q")
    joined = counted.join(same, (F.col("_p") == F.col("_q")) & F.col(by).eqNullSafe(F.col("_g")), "left")
    return joined.withColumn("earlier", (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("bigint")).withColumn("last_earlier", F.coalesce("_l", "_from")).select(*df.columns, "earlier", "last_earlier")


def latest_before(df: DataFrame, by: str, order: Sequence[str], value: str) -> DataFrame:
    """``df`` with the number of earlier non-empty values of its group and the last of them: constant state a row."""
    return before(df, by, order, value)


def context(df: DataFrame, by: str, order: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``earlier`` and ``position``: a row's whole context is the values of its group at positions up to ``earlier``.

    Values that are null or empty have no position. Constant state a row, nothing is left out.
    """
    filled = F.length(F.trim(F.col(value))) > 0
    return before(df, by, order, value).drop("last_earlier").withColumn("position", F.when(filled, F.col("earlier") + 1))


def context_lists(placed: DataFrame, by: str, value: str) -> DataFrame:
    """(by, previous): all values of each group in order, for work that comes after them."""
    rows = placed.where("position is not null").groupBy(by).agg(F.array_sort(F.collect_list(F.struct("position", value))).alias("_l"))
    return rows.select(by, F.col("_l")[value].alias("previous"))
