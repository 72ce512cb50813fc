"""Verdict facts and the reports over them: success rates, best of n, pass at k, pivots, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERDICT = "struct<verified:string,error:string,timestamp:string,test_cases:string>"


def normalise(raw: Column) -> Column:
    """A verifier result of either shape (object, list of objects) as an array; anything else is empty.

    Elements that are no objects and empty objects are left out.
    """
    text = F.trim(raw)
    one = F.when(F.regexp_replace(text, r"\s", "") != "{}", F.array(F.from_json(text, VERDICT)))
    many = F.from_json(text, f"array<{VERDICT}>")
    both = F.when(text.startswith("["), many).when(text.startswith("{"), one)
    return F.filter(F.coalesce(both, F.array().cast(f"array<{VERDICT}>")), lambda v: v.isNotNull())


def first_attempts(attempts: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None) -> DataFrame:
    """``attempt_ord`` (from 1) by ``order`` within ``keys``; only the first n, all if n is None."""
    ranked = attempts.withColumn("attempt_ord", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked if n is None else ranked.where(F.col("attempt_ord") <= n)


def facts(attempts: DataFrame, result_col: str, keep: Sequence[str]) -> DataFrame:
    """One row per verdict: ``keep``, verdict_ord from 0, verified 1, 0 or null."""
    out = attempts.select(*keep, F.posexplode(normalise(F.col(result_col))).alias("verdict_ord", "_v"))
    return out.select(*keep, "verdict_ord", F.expr("try_cast(_v.verified as int)").alias("verified"))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def verification_metrics(verdicts: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """correct, incorrect and unknown verdicts per group; the rate is over the first two, 0 without any."""
    right, wrong = F.col("verified") == 1, F.col("verified") == 0
    counted = verdicts.groupBy(*by).agg(
        F.count_if(right).alias("correct"), F.count_if(wrong).alias("incorrect"), F.count_if(~F.coalesce(right | wrong, F.lit(False))).alias("unknown")
    )
    return counted.withColumn("success_rate", share(F.col("correct"), F.col("correct") + F.col("incorrect")))


def best_of_n(verdicts: DataFrame, problem: str = "problem_key", model: str = "model") -> DataFrame:
    """Per model the share of problems with a right verdict, among those with any verdict that is not null."""
    per = verdicts.where("verified is not null").groupBy(model, problem).agg(F.max((F.col("verified") == 1).cast("int")).alias("solved"))
    return per.groupBy(model).agg(F.avg("solved").alias("best_of_n"), F.count(F.lit(1)).alias("problems"))


def attempt_scores(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the verdicts of each attempt that are not null."""
    return verdicts.where("verified is not null").groupBy(*keys).agg(F.avg("verified").alias("score"))


def relative_performance(scores: DataFrame, baseline: str, model: str = "model") -> DataFrame:
    """Mean score per model against the baseline's (0 where the baseline has none)."""
    means = scores.groupBy(model).agg(F.avg("score").alias("mean_score"), F.count(F.lit(1)).alias("sample_size"))
    base = F.max(F.when(F.col(model) == baseline, F.col("mean_score"))).over(Window.partitionBy())
    return means.withColumn("relative_performance", share(F.col("mean_score"), base))


def level_model_metrics(attempts: DataFrame, result_col: str, level: str = "level", model: str = "model", problem: str = "problem_key") -> DataFrame:
    """Per level and model: mean and best of all attempts. A problem with an attempt counts even without a verdict."""
    checked = normalise(F.col(result_col))
    known = F.filter(F.transform(checked, lambda v: v["verified"].try_cast("int")), lambda x: x.isNotNull())
    scored = attempts.withColumn("known", known).withColumn("score", F.when(F.size("known") > 0, F.aggregate("known", F.lit(0.0), lambda a, x: a + x) / F.size("known")))
    per = scored.groupBy(level, model, problem).agg(F.avg("score").alias("score"), F.max(F.coalesce(F.array_contains("known", 1), F.lit(False)).cast("int")).alias("solved"))
    return per.groupBy(level, model).agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean_score"), F.avg("solved").alias("best_of_n"), F.count(F.lit(1)).alias("sample_size"))


def pass_at_k(verdicts: DataFrame, k: int, problem: str = "problem_key", by: Sequence[str] = ("model",)) -> DataFrame:
    """For every j up to k: the share of problems solved by attempt j or before."""
    first = verdicts.groupBy(*by, problem).agg(F.min(F.when(F.col("verified") == 1, F.col("attempt_ord"))).alias("first_right"))
    spread = first.select(*by, "first_right", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("k"))
    return spread.groupBy(*by, "k").agg(F.count_if(F.col("first_right") <= F.col("k")).alias("passed"), F.count(F.lit(1)).alias("problems")).withColumn("pass_at_k", share(F.col("passed"), F.col("problems")))


def solver_summary(verdicts: DataFrame, k: int, problem: str = "problem_key", by: Sequence[str] = ("model",)) -> DataFrame:
    """Problems passed and failed within k attempts, attempts used, and those an early stop would save."""
    per = verdicts.groupBy(*by, problem).agg(F.min(F.when((F.col("verified") == 1) & (F.col("attempt_ord") <= k), F.col("attempt_ord"))).alias("first_right"), F.least(F.max("attempt_ord"), F.lit(k)).alias("made"))
    used = F.coalesce("first_right", "made")
    return per.groupBy(*by).agg(
        F.count_if(F.col("first_right").isNotNull()).alias("passed"), F.count_if(F.col("first_right").isNull()).alias("failed"), F.sum(used).cast("bigint").alias("attempts_used"), F.sum(F.col("made") - used).cast("bigint").alias("attempts_saved")
    )


def per_problem_pivot(verdicts: DataFrame, models: Sequence[str], problem: str = "problem_key", model: str = "model") -> DataFrame:
    """Mean verdict of each of the models per problem, and the mean of those there are."""
    means = [F.avg(F.when(F.col(model) == m, F.col("verified"))).alias(f"score_{k}") for k, m in enumerate(models)]
    wide = verdicts.where(F.col(model).isin(*models) & F.col("verified").isNotNull()).groupBy(problem).agg(*means)
    there = F.filter(F.array(*(f"score_{k}" for k in range(len(models)))), lambda x: x.isNotNull())
    return wide.withColumn("row_mean", F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there))


def level_order(level: Column) -> list[Column]:
    """Sort keys: numeric levels first and by number, the rest by name."""
    number = level.try_cast("int")
    return [number.isNull(), number, level]


def output_types(cases: DataFrame, type_col: str = "output_type", problem: str = "record_id", list_below: int = 20) -> DataFrame:
    """Count per output type; the sorted problems of types that occur less than ``list_below`` times.

    Types are counted first, so only the problems of rare types are ever collected.
    """
    counts = cases.groupBy(type_col).agg(F.count(F.lit(1)).alias("n"))
    rare = cases.join(counts.where(F.col("n") < list_below), type_col).groupBy(type_col).agg(F.array_join(F.sort_array(F.collect_set(F.col(problem).cast("bigint"))), ",").alias("problems"))
    return counts.join(rare, type_col, "left").select(type_col, "n", "problems")
