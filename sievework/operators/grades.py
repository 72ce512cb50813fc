"""Repeated grades: the latest by two rules, predicates on scores, resuming, numbering, document form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("problem_quality", "solution_completeness", "solution_quality", "test_case_quality")


def latest(grades: DataFrame, keys: Sequence[str], index: str = "run_index", tie: Sequence[str] = ("grade_row_id",)) -> DataFrame:
    """The row of greatest index per key; the first by ``tie`` among equals. A null index comes last.

    An aggregate with partial sums, not a window: a key with very many rows is no hot task.
    """
    others = [c for c in grades.columns if c not in keys]
    order = F.struct(F.coalesce(F.col(index), F.lit(-(2**31))), *((-F.col(t)).alias(f"_{t}") for t in tie))
    return grades.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_g")).select(*keys, "_g.*")


def first_model_last_grade(grades: DataFrame, problem: str, model: str, model_order: Column, grade_order: Sequence[str]) -> DataFrame:
    """The last grade (in list order) of the first model (in document order) of each problem."""
    first = grades.groupBy(problem).agg(F.min_by(F.col(model), model_order).alias(model))
    mine = grades.join(first, [problem, model], "left_semi")
    others = [c for c in grades.columns if c != problem]
    return mine.groupBy(problem).agg(F.max_by(F.struct(*others), F.struct(*grade_order)).alias("_g")).select(problem, "_g.*")


def document_grade(gradings: Column, legacy: Column) -> Column:
    """The last grade in the list of the first model (document order) that has any, else the older flat grade."""
    lists = F.filter(F.map_values(gradings), lambda g: F.coalesce(F.size(g), F.lit(0)) > 0)
    return F.coalesce(F.try_element_at(F.try_element_at(lists, F.lit(1)), F.lit(-1)), legacy)


def passes(metrics: Sequence[str], threshold: float, optional: Column | None = None) -> Column:
    """All metrics there and at least int(threshold x 100); ``optional`` must too where it is present."""
    least = F.lit(int(threshold * 100))
    ok = F.forall(F.array(*(F.coalesce(F.col(m) >= least, F.lit(False)) for m in metrics)), lambda x: x)
    return ok if optional is None else ok & optional


def only_failing(grades: DataFrame, problem: str, grader: str, metric: str, threshold: int, others: Sequence[str] = METRICS, required: Sequence[str] | None = None) -> DataFrame:
    """Problems of which some latest grade is low on ``metric`` and none on any other; missing scores are skipped.

    With ``required`` only these graders count, and all of them must have graded the problem.
    """
    if required is not None:
        grades = grades.where(F.col(grader).isin(*required))
    low = {m: F.coalesce(F.col(m) < threshold, F.lit(False)) for m in others}
    rest = F.lit(False)
    for m in others:
        if m != metric:
            rest = rest | low[m]
    return grades.groupBy(problem).agg(F.count_if(low[metric]).alias("low_here"), F.count_if(rest).alias("low_elsewhere"), F.count(F.lit(1)).alias("graders"), F.count_distinct(grader).alias("_d")).where(f"low_here > 0 and low_elsewhere = 0 and _d >= {len(required or ())}").drop("_d")


def comments(grades: DataFrame, problem: str, grader: str, metrics: Sequence[str] = ("problem_quality",)) -> DataFrame:
    """One row per comment: problem, grader, metric, score, comment; blank ones are left out."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("score"), F.col(f"{m}_comment").alias("comment")) for m in metrics)))
    return grades.select(problem, grader, each.alias("_c")).select(problem, grader, "_c.*").where("comment is not null and trim(comment) <> ''")


def runs_needed(grades: DataFrame, problem: str, grader: str, wanted: int) -> DataFrame:
    """Grades there are per problem and grader, and how many of ``wanted`` are still due."""
    return grades.groupBy(problem, grader).agg(F.count(F.lit(1)).alias("runs")).withColumn("needed", F.greatest(F.lit(wanted) - F.col("runs"), F.lit(0)).cast("bigint"))


def seed_only_due(documents: DataFrame) -> DataFrame:
    """Documents with a seed whose correspondence to it has not been graded: ``original_seed`` and the flat ``quality``."""
    return documents.where(F.col("original_seed").isNotNull() & F.col("quality.seed_correspondence").isNull())


def next_index(grades: DataFrame, problem: str, grader: str, index: str = "run_index") -> DataFrame:
    """The index the next grade takes: greatest so far and one, 0 without any."""
    return grades.groupBy(problem, grader).agg((F.coalesce(F.max(index), F.lit(-1)) + 1).cast("bigint").alias("next_index"))


def append(base: DataFrame, new: DataFrame, keys: Sequence[str], index: str, order: Sequence[str]) -> DataFrame:
    """``new`` rows after those of ``base``, numbered on from the greatest index of their key."""
    start = base.groupBy(*keys).agg(F.max(index).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = new.join(start, list(keys), "left").withColumn(index, (F.coalesce("_start", F.lit(-1)) + place).cast("int")).drop("_start")
    return base.unionByName(numbered, allowMissingColumns=True)


def to_documents(grades: DataFrame, problem: str, grader: str, index: str = "run_index", metrics: Sequence[str] = METRICS, most: int = 5000) -> DataFrame:
    """Document form: problem, part, map grader -> grades by index.

    A problem of more than ``most`` grades comes in several parts (by a hash of the row id),
    so no document, and no task's list, grows with a hot problem.
    """
    large = grades.groupBy(problem).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    parts = F.coalesce(F.ceil(F.col("_n") / most), F.lit(1))
    placed = grades.join(large, problem, "left").withColumn("part", F.pmod(F.xxhash64("grade_row_id"), parts).cast("int")).drop("_n")
    lists = placed.groupBy(problem, "part", grader).agg(F.sort_array(F.collect_list(F.struct(F.col(index), F.col("grade_row_id"), *metrics))).alias("runs"))
    return lists.groupBy(problem, "part").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(grader, "runs")))).alias("quality_gradings"))


def from_documents(documents: DataFrame, problem: str, grader: str) -> DataFrame:
    """The long form back from ``to_documents``."""
    models = documents.select(problem, F.explode("quality_gradings").alias(grader, "runs"))
    return models.select(problem, grader, F.posexplode("runs").alias("pos", "_g")).select(problem, grader, "pos", "_g.*")


def migrate_legacy(documents: DataFrame, model_id: str, when: Column) -> DataFrame:
    """A flat ``quality`` struct becomes the grade 0 of ``model_id`` unless that model has grades."""
    fresh = F.create_map(F.lit(model_id), F.array(F.struct(F.lit(0).alias("index"), when.alias("timestamp"), "quality.*")))
    missing = F.col("quality").isNotNull() & ~F.coalesce(F.map_contains_key("quality_gradings", model_id), F.lit(False))
    kind = documents.schema["quality_gradings"].dataType.simpleString()
    return documents.withColumn("quality_gradings", F.when(missing, F.map_concat(F.coalesce("quality_gradings", F.create_map().cast(kind)), fresh.cast(kind))).otherwise(F.col("quality_gradings")))


def renamed(name: str, old: str) -> Column:
    """A field that had another name: the new one where there is a value, else the old."""
    return F.coalesce(F.col(name), F.col(old)).alias(name)
