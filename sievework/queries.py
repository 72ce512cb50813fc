"""Queries over the driver's tables, each with the same in SQL where SQL can say it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import code as C
from sievework.functions import text as T
from sievework.operators import allocate, compare, grades, merge, nested, predicates, verdicts
from sievework.plans import cases, pipeline
from sievework.plans.providers import Stub, call
from sievework.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The attempts that count for best of n and pass at k.
N = 3
MODELS = ("orbis-large", "orbis-mini")
BASELINE = "orbis-large"
LEVELS = {"Advanced Undergraduate": 0.4, "Graduate": 0.3, "Advanced Graduate": 0.2, "Postgraduate": 0.1}
TOTAL = 250


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- verdicts ---------------------------------------------------------------------

VERDICTS_SQL = """
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY problem_key, model ORDER BY attempt_no, attempt_id) AS attempt_ord
    FROM model_solutions WHERE problem_key IS NOT NULL),
  parts AS (
    SELECT problem_key, model, attempt_ord, attempt_id, unnest(CASE
      WHEN trim(verifier_result) LIKE '[%' THEN from_json(verifier_result, '["JSON"]')
      WHEN trim(verifier_result) LIKE '{%' AND regexp_replace(verifier_result, '\\s', '', 'g') <> '{}' THEN [verifier_result::JSON]
      ELSE [] END) AS v
    FROM ranked),
  verdicts AS (
    SELECT problem_key, model, attempt_ord, attempt_id, try_cast(json_extract_string(v, '$.verified') AS int) AS verified FROM parts)
"""


def ranked_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "model_solutions").where("problem_key is not null").select("attempt_id", "problem_key", "model", "attempt_no", "verifier_result")
    return verdicts.first_attempts(attempts, ["problem_key", "model"], ["attempt_no", "attempt_id"], None)


def verdict_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.facts(ranked_attempts(spark, sf_dir), "verifier_result", ["problem_key", "model", "attempt_ord", "attempt_id"])


@query(f"WITH {VERDICTS_SQL}, per AS (SELECT model, problem_key, max((verified = 1)::int) AS s FROM verdicts WHERE attempt_ord <= {N} AND verified IS NOT NULL GROUP BY 1, 2) SELECT model, avg(s) AS best_of_n, count(*) AS problems FROM per GROUP BY 1")
def best_of_n(spark, sf_dir):
    return verdicts.best_of_n(verdict_facts(spark, sf_dir).where(F.col("attempt_ord") <= N))


@query(f"WITH {VERDICTS_SQL} SELECT model, count(*) FILTER (verified = 1) AS correct, count(*) FILTER (verified = 0) AS incorrect, count(*) FILTER (verified IS NULL OR verified NOT IN (0, 1)) AS unknown, coalesce(count(*) FILTER (verified = 1)::double / nullif(count(*) FILTER (verified IN (0, 1)), 0), 0.0) AS success_rate FROM verdicts GROUP BY 1")
def verification_metrics(spark, sf_dir):
    return verdicts.verification_metrics(verdict_facts(spark, sf_dir))


def level_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = table(spark, sf_dir, "topics").select("topic_entry_id", F.col("difficulty_level").alias("level"))
    problems = table(spark, sf_dir, "problem_metadata").select("problem_key", "topic_entry_id")
    leveled = problems.join(F.broadcast(topics), "topic_entry_id", "left").select("problem_key", F.coalesce("level", F.lit("Unknown")).alias("level"))
    return ranked_attempts(spark, sf_dir).join(leveled, "problem_key")


LEVELED_SQL = f"""
  {VERDICTS_SQL},
  leveled AS (SELECT p.problem_key, coalesce(t.difficulty_level, 'Unknown') AS level FROM problem_metadata p LEFT JOIN topics t USING (topic_entry_id)),
  scored AS (
    SELECT l.level, r.model, r.problem_key, r.attempt_id, avg(v.verified) AS score, coalesce(max((v.verified = 1)::int), 0) AS solved
    FROM ranked r JOIN leveled l USING (problem_key) LEFT JOIN verdicts v USING (attempt_id) GROUP BY 1, 2, 3, 4),
  per AS (SELECT level, model, problem_key, avg(score) AS score, max(solved) AS solved FROM scored GROUP BY 1, 2, 3)
"""


@query(f"WITH {LEVELED_SQL} SELECT level, model, round(coalesce(avg(score), 0.0), 9) AS mean_score, avg(solved) AS best_of_n, count(*) AS sample_size FROM per GROUP BY 1, 2")
def level_model_metrics(spark, sf_dir):
    return verdicts.level_model_metrics(level_attempts(spark, sf_dir), "verifier_result").withColumn("mean_score", F.round("mean_score", 9))


@query(f"WITH {LEVELED_SQL}, m AS (SELECT level, model, avg(solved) AS best_of_n FROM per GROUP BY 1, 2) SELECT level, model, best_of_n, row_number() OVER (ORDER BY try_cast(level AS int) IS NULL, try_cast(level AS int), level, model) AS place FROM m")
def level_sorted_report(spark, sf_dir):
    from pyspark.sql import Window

    metrics = verdicts.level_model_metrics(level_attempts(spark, sf_dir), "verifier_result")
    order = [*verdicts.level_order(F.col("level")), F.col("model")]
    return metrics.select("level", "model", "best_of_n", F.row_number().over(Window.partitionBy().orderBy(*order)).cast("bigint").alias("place"))


@query(f"WITH {VERDICTS_SQL}, s AS (SELECT model, problem_key, attempt_ord, avg(verified) AS score FROM verdicts WHERE verified IS NOT NULL GROUP BY 1, 2, 3), m AS (SELECT model, avg(score) AS mean_score, count(*) AS sample_size FROM s GROUP BY 1) SELECT model, round(mean_score, 9) AS mean_score, sample_size, round(coalesce(mean_score / nullif((SELECT mean_score FROM m WHERE model = '{BASELINE}'), 0), 0.0), 9) AS relative_performance FROM m")
def relative_performance(spark, sf_dir):
    scores = verdicts.attempt_scores(verdict_facts(spark, sf_dir), ["model", "problem_key", "attempt_ord"])
    out = verdicts.relative_performance(scores, BASELINE)
    return out.withColumn("mean_score", F.round("mean_score", 9)).withColumn("relative_performance", F.round("relative_performance", 9))


@query(f"WITH {VERDICTS_SQL}, f AS (SELECT model, problem_key, min(CASE WHEN verified = 1 THEN attempt_ord END) AS a FROM verdicts GROUP BY 1, 2) SELECT model, k::int AS k, count(*) FILTER (a <= k) AS passed, count(*) AS problems, count(*) FILTER (a <= k)::double / count(*) AS pass_at_k FROM f, (SELECT unnest(range(1, {N} + 1)) AS k) GROUP BY 1, 2")
def pass_at_k(spark, sf_dir):
    return verdicts.pass_at_k(verdict_facts(spark, sf_dir), N)


@query(f"WITH {VERDICTS_SQL}, f AS (SELECT model, problem_key, min(CASE WHEN verified = 1 AND attempt_ord <= {N} THEN attempt_ord END) AS a, least(max(attempt_ord), {N}) AS made FROM verdicts GROUP BY 1, 2) SELECT model, count(a) AS passed, count(*) - count(a) AS failed, sum(coalesce(a, made))::bigint AS attempts_used, sum(made - coalesce(a, made))::bigint AS attempts_saved FROM f GROUP BY 1")
def solver_summary(spark, sf_dir):
    return verdicts.solver_summary(verdict_facts(spark, sf_dir), N)


@query(f"WITH {VERDICTS_SQL}, w AS (SELECT problem_key, avg(verified) FILTER (model = '{MODELS[0]}') AS score_0, avg(verified) FILTER (model = '{MODELS[1]}') AS score_1 FROM verdicts WHERE model IN {MODELS} AND verified IS NOT NULL GROUP BY 1) SELECT problem_key, score_0, score_1, CASE WHEN score_0 IS NULL THEN score_1 WHEN score_1 IS NULL THEN score_0 ELSE (score_0 + score_1) / 2 END AS row_mean FROM w")
def per_problem_pivot(spark, sf_dir):
    return verdicts.per_problem_pivot(verdict_facts(spark, sf_dir), MODELS)


# --- grades -----------------------------------------------------------------------

LATEST_SQL = """
  good AS (SELECT * FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY problem_key, grader_id ORDER BY coalesce(run_index, -2147483648) DESC, grade_row_id) AS k FROM good) WHERE k = 1)
"""


def good_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "quality_grades").where("problem_key is not null and grader_id is not null")


def latest_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grades.latest(good_grades(spark, sf_dir), ["problem_key", "grader_id"])


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, grade_row_id, run_index, problem_quality, solution_quality FROM latest")
def latest_grade(spark, sf_dir):
    return latest_of(spark, sf_dir).select("problem_key", "grader_id", "grade_row_id", "run_index", "problem_quality", "solution_quality")


@query("""WITH good AS (SELECT * FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL),
  firsts AS (SELECT problem_key, grader_id FROM (SELECT problem_key, grader_id, row_number() OVER (PARTITION BY problem_key ORDER BY grade_row_id) AS k FROM good) WHERE k = 1)
  SELECT problem_key, grader_id, grade_row_id, problem_quality FROM (SELECT g.*, row_number() OVER (PARTITION BY problem_key ORDER BY grade_row_id DESC) AS k FROM good g SEMI JOIN firsts f ON g.problem_key = f.problem_key AND g.grader_id = f.grader_id) WHERE k = 1""")
def first_model_last_grade(spark, sf_dir):
    rows = good_grades(spark, sf_dir).select("problem_key", "grader_id", "grade_row_id", "problem_quality")
    return grades.first_model_last_grade(rows, "problem_key", "grader_id", F.col("grade_row_id"), ["grade_row_id"])


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, CASE WHEN coalesce(problem_quality >= 80 AND solution_completeness >= 80 AND solution_quality >= 80, false) THEN 'ok' ELSE 'qc_failed' END AS status FROM latest")
def qc_filter(spark, sf_dir):
    ok = grades.passes(("problem_quality", "solution_completeness", "solution_quality"), 0.8)
    return predicates.with_status(latest_of(spark, sf_dir), ok, "qc_failed").select("problem_key", "grader_id", "status")


@query(f"WITH {LATEST_SQL}, s AS (SELECT problem_key, CASE WHEN coalesce(problem_quality >= 80 AND solution_completeness >= 80 AND solution_quality >= 80, false) THEN 'ok' ELSE 'qc_failed' END AS status FROM latest) SELECT status, count(*) AS rows, count(DISTINCT problem_key) AS problems FROM s GROUP BY 1")
def status_routing(spark, sf_dir):
    return qc_filter(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("problem_key").alias("problems"))


REQUIRED = ("orbis-large", "lumen-9b")


@query(f"WITH {LATEST_SQL} SELECT problem_key, count(*) FILTER (test_case_quality < 60) AS low_here, count(*) FILTER (problem_quality < 60 OR solution_completeness < 60 OR solution_quality < 60) AS low_elsewhere, count(*) AS graders FROM latest WHERE grader_id IN {REQUIRED} GROUP BY 1 HAVING low_here > 0 AND low_elsewhere = 0 AND count(DISTINCT grader_id) = {len(REQUIRED)}")
def test_case_only_failures(spark, sf_dir):
    return grades.only_failing(latest_of(spark, sf_dir), "problem_key", "grader_id", "test_case_quality", 60, required=REQUIRED)


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, 'problem_quality' AS metric, problem_quality AS score, problem_quality_comment AS comment FROM latest WHERE trim(problem_quality_comment) <> ''")
def extract_reviews(spark, sf_dir):
    return grades.comments(latest_of(spark, sf_dir), "problem_key", "grader_id")


@query("SELECT problem_key, grader_id, count(*) AS runs, greatest(3 - count(*), 0)::bigint AS needed FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL GROUP BY 1, 2")
def qc_runs_needed(spark, sf_dir):
    return grades.runs_needed(good_grades(spark, sf_dir), "problem_key", "grader_id", 3)


@query("SELECT problem_key, grader_id, (coalesce(max(run_index), -1) + 1)::bigint AS next_index FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL GROUP BY 1, 2")
def next_grade_index(spark, sf_dir):
    return grades.next_index(good_grades(spark, sf_dir), "problem_key", "grader_id")


@query("SELECT problem_key, grader_id, grade_row_id, run_index, problem_quality, solution_completeness, solution_quality, test_case_quality FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL")
def grades_map_roundtrip(spark, sf_dir):
    documents = grades.to_documents(good_grades(spark, sf_dir), "problem_key", "grader_id")
    return grades.from_documents(documents, "problem_key", "grader_id").drop("pos")


# --- allocation -------------------------------------------------------------------

LEVELS_SQL = ", ".join(f"('{level}', {ratio})" for level, ratio in LEVELS.items())
COUNTS_SQL = f"""
  lv AS (SELECT DISTINCT difficulty_level AS level, level_ord FROM topics),
  w AS (SELECT level, level_ord, r / sum(r) OVER () * {TOTAL} AS x FROM (VALUES {LEVELS_SQL}) AS v(level, r) JOIN lv USING (level)),
  f AS (SELECT *, floor(x) AS fl, x - floor(x) AS rem FROM w),
  counts AS (SELECT level, level_ord, (fl + (row_number() OVER (ORDER BY rem DESC, level_ord) <= {TOTAL} - sum(fl) OVER ())::int)::bigint AS n FROM f)
"""


def level_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = table(spark, sf_dir, "topics").select(F.col("difficulty_level").alias("level"), "level_ord").distinct()
    wanted = spark.createDataFrame(list(LEVELS.items()), "level string, ratio double")
    return allocate.level_counts(levels.join(F.broadcast(wanted), "level"), TOTAL)


def distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = table(spark, sf_dir, "topics").withColumnRenamed("difficulty_level", "level").drop("level_ord")
    return allocate.distribute(level_plan(spark, sf_dir), topics, "level", "level_ord", "topic_entry_id", "topic_ord")


@query(f"""WITH {COUNTS_SQL},
  r AS (SELECT difficulty_level AS level, topic_entry_id, row_number() OVER (PARTITION BY difficulty_level ORDER BY topic_ord) - 1 AS slot, count(*) OVER (PARTITION BY difficulty_level) AS size FROM topics),
  t AS (SELECT level, level_ord, unnest(range(0, n)) AS turn FROM counts)
  SELECT t.level, topic_entry_id, row_number() OVER (ORDER BY level_ord, turn) AS problem_no FROM t JOIN r ON t.level = r.level AND turn % size = slot""")
def distribute_problems(spark, sf_dir):
    return distributed(spark, sf_dir)


@query("WITH have AS (SELECT DISTINCT topic_entry_id FROM problem_metadata WHERE topic_entry_id IS NOT NULL) SELECT topic_entry_id, row_number() OVER (ORDER BY topic_entry_id) + 1000 AS problem_no FROM topics ANTI JOIN have USING (topic_entry_id)")
def assign_topics(spark, sf_dir):
    have = table(spark, sf_dir, "problem_metadata").where("topic_entry_id is not null")
    return allocate.assign_requested(table(spark, sf_dir, "topics").select("topic_entry_id"), have, "topic_entry_id", "topic_entry_id", 1001)


@query("SELECT problem_key, row_number() OVER (ORDER BY problem_key) - 1 AS item_no, (row_number() OVER (ORDER BY problem_key) - 1) % 8 AS worker FROM problem_metadata")
def worker_assignment(spark, sf_dir):
    return allocate.workers(table(spark, sf_dir, "problem_metadata").select("problem_key"), 8, ["problem_key"])


@query("SELECT p.problem_key, p.topic_entry_id, t.difficulty_level AS level, t.topic FROM problem_metadata p JOIN topics t USING (topic_entry_id)")
def assignment_topic_join(spark, sf_dir):
    topics = table(spark, sf_dir, "topics").select("topic_entry_id", F.col("difficulty_level").alias("level"), "topic", "topic_ord")
    return allocate.first_match(table(spark, sf_dir, "problem_metadata").select("problem_key", "topic_entry_id"), topics, "topic_entry_id", "topic_ord").select("problem_key", "topic_entry_id", "level", "topic")


@query("SELECT problem_key, problem_id FROM problem_metadata ANTI JOIN (SELECT problem_key FROM model_solutions WHERE problem_key IS NOT NULL) USING (problem_key)")
def remaining_assignment(spark, sf_dir):
    done = table(spark, sf_dir, "model_solutions").where("problem_key is not null")
    return allocate.remaining(table(spark, sf_dir, "problem_metadata").select("problem_key", "problem_id"), done, "problem_key")


@query("SELECT count(DISTINCT problem_key) AS assigned, (coalesce(max(problem_key), 0) + 1)::bigint AS next_id, greatest(1000000 - count(DISTINCT problem_key), 0)::bigint AS to_add FROM problem_metadata")
def assignment_totals(spark, sf_dir):
    return allocate.totals(table(spark, sf_dir, "problem_metadata"), "problem_key", 1_000_000)


@query("SELECT DISTINCT topic_entry_id FROM documents WHERE topic_entry_id IS NOT NULL AND topic_entry_id NOT IN (SELECT topic_entry_id FROM topics WHERE difficulty_level <> 'Graduate')")
def unknown_topics(spark, sf_dir):
    known = table(spark, sf_dir, "topics").where("difficulty_level <> 'Graduate'")
    return allocate.unknown_ids(table(spark, sf_dir, "documents").where("topic_entry_id is not null"), known, "topic_entry_id")


#: White space of any kind, as the inside of a class of SQL's regular expressions.
SPACE = r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


@query(f"""WITH h AS (SELECT pair_id, harvested_at, md5(coalesce(arxiv_id, '') || ':' || coalesce(problem, '')) AS pair_hash, regexp_matches(problem, '[^{SPACE}]') AND regexp_matches(solution, '[^{SPACE}]') AS ok FROM matched_pairs)
  SELECT pair_id, pair_hash FROM h WHERE ok AND harvested_at >= '2025-01-01' AND pair_hash NOT IN (SELECT pair_hash FROM h WHERE harvested_at < '2025-01-01' OR harvested_at IS NULL)""")
def seed_pair_anti_join(spark, sf_dir):
    """Valid pairs of the new harvest that no earlier one brought."""
    pairs = table(spark, sf_dir, "matched_pairs").withColumn("pair_hash", T.pair_hash(F.col("arxiv_id"), F.col("problem")))
    new = F.coalesce(F.col("harvested_at") >= "2025-01-01", F.lit(False))
    return allocate.remaining(predicates.valid_pairs(pairs.where(new)).select("pair_id", "pair_hash"), pairs.where(~new), "pair_hash").select("pair_id", "pair_hash")


@query("""WITH u AS (SELECT 'example' AS kind, pair_id FROM matched_pairs WHERE seed_type = 'example' UNION ALL SELECT 'matched', pair_id FROM matched_pairs WHERE seed_type = 'matched')
  SELECT kind, pair_id, row_number() OVER (ORDER BY kind, pair_id) + 100 AS index_no FROM u ORDER BY kind, pair_id LIMIT 40""")
def seed_limit_index(spark, sf_dir):
    pairs = table(spark, sf_dir, "matched_pairs")
    both = pairs.where("seed_type = 'example'").select(F.lit("example").alias("kind"), "pair_id").unionByName(pairs.where("seed_type = 'matched'").select(F.lit("matched").alias("kind"), "pair_id"))
    # the limit is the feature: the first 40 seeds still to do
    return allocate.numbered(both.orderBy("kind", "pair_id").limit(40), ["kind", "pair_id"], "index_no", 101)


@query("""SELECT problem_key, count(d) OVER w AS earlier, last_value(d IGNORE NULLS) OVER w AS last_earlier, CASE WHEN d IS NOT NULL THEN count(d) OVER w + 1 END AS position, d AS listed
  FROM (SELECT problem_key, topic_entry_id, CASE WHEN trim(problem_description) <> '' THEN problem_description END AS d FROM problem_metadata WHERE topic_entry_id IS NOT NULL)
  WINDOW w AS (PARTITION BY topic_entry_id ORDER BY problem_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def previous_context(spark, sf_dir):
    """The running context of every problem: all descriptions listed in its topic at positions up to ``earlier``, the last of them beside it."""
    problems = table(spark, sf_dir, "problem_metadata").where("topic_entry_id is not null").select("problem_key", "topic_entry_id", "problem_description")
    seen = allocate.before(problems, "topic_entry_id", ["problem_key"], "problem_description")
    listed = F.when(F.length(F.trim("problem_description")) > 0, F.col("problem_description"))
    position = F.when(listed.isNotNull(), F.col("earlier") + 1)
    return seen.select("problem_key", "earlier", "last_earlier", position.alias("position"), listed.alias("listed"))


@query("""SELECT problem_key, topic_entry_id, count(d) OVER w AS earlier, CASE WHEN d IS NOT NULL THEN count(d) OVER w + 1 END AS position, problem_description
  FROM (SELECT *, CASE WHEN trim(problem_description) <> '' THEN problem_description END AS d FROM problem_metadata WHERE topic_entry_id IS NOT NULL)
  WINDOW w AS (PARTITION BY topic_entry_id ORDER BY problem_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def whole_context(spark, sf_dir):
    """The context of a problem is the descriptions of its topic at positions up to ``earlier``."""
    problems = table(spark, sf_dir, "problem_metadata").where("topic_entry_id is not null").select("problem_key", "topic_entry_id", "problem_description")
    return allocate.context(problems, "topic_entry_id", ["problem_key"], "problem_description")


@query()
def generation_prompts(spark, sf_dir):
    """Prompts of the next problems, each with all descriptions its topic has."""
    topics = table(spark, sf_dir, "topics").select(F.col("topic_entry_id").alias("id"), "topic", "description", F.col("difficulty_level").alias("level"), "level_ord", "topic_ord")
    seen = whole_context(spark, sf_dir).select(F.col("topic_entry_id").alias("id"), "position", F.col("problem_description").alias("description"))
    return pipeline.generation_plan(topics, pipeline.Config(num_problems=TOTAL, level_split=LEVELS), previous=seen)


@query("SELECT doc_id, CASE WHEN k <= total - (total - floor(total * 0.8)::bigint) THEN 'train' ELSE 'val' END AS part FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS total FROM documents)")
def train_val_split(spark, sf_dir):
    return allocate.split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("""WITH w AS (SELECT difficulty_level AS level, count(*)::double AS w FROM topics GROUP BY 1), hi AS (SELECT level, sum(w) OVER (ORDER BY level) / sum(w) OVER () AS hi FROM w)
  SELECT problem_key, min_by(level, hi) AS level FROM (SELECT problem_key, ('0x' || left(md5('7:' || problem_key), 13))::bigint / 4503599627370496.0::double AS u FROM problem_metadata) JOIN hi ON hi > u GROUP BY 1""")
def weighted_sample(spark, sf_dir):
    weights = table(spark, sf_dir, "topics").groupBy(F.col("difficulty_level").alias("level")).agg(F.count(F.lit(1)).cast("double").alias("w"))
    return allocate.weighted_draws(weights, table(spark, sf_dir, "problem_metadata").select("problem_key"), "level", "w")


# --- merge and routing --------------------------------------------------------------


@query("""WITH k AS (SELECT attempt_id, problem_key, model, attempt_ts, detailed_solution, CASE WHEN attempt_ts IS NOT NULL THEN attempt_ts || chr(1) || coalesce(left(detailed_solution, 500), '') END AS key, coalesce(problem_key, -1) AS pk FROM model_solutions),
  b AS (SELECT *, row_number() OVER (PARTITION BY pk, model, key, CASE WHEN key IS NULL THEN attempt_id END ORDER BY attempt_id) AS nth FROM k WHERE attempt_id % 2 = 0),
  i AS (SELECT *, row_number() OVER (PARTITION BY pk, model, key, CASE WHEN key IS NULL THEN attempt_id END ORDER BY attempt_id) AS nth FROM k WHERE attempt_id % 2 = 1 OR attempt_id % 10 = 0)
  SELECT coalesce(b.pk, i.pk) AS pk, coalesce(b.model, i.model) AS model, coalesce(i.attempt_id, b.attempt_id) AS attempt_id, CASE WHEN b.pk IS NULL THEN 'incoming' WHEN i.pk IS NULL THEN 'base' ELSE 'both' END AS merged_from
  FROM b FULL OUTER JOIN i ON b.pk = i.pk AND b.model = i.model AND b.key = i.key AND b.nth = i.nth""")
def merge_attempts(spark, sf_dir):
    rows = table(spark, sf_dir, "model_solutions").where("model is not null").select(F.coalesce("problem_key", F.lit(-1)).alias("pk"), "model", "attempt_id", "attempt_ts", "detailed_solution")
    merged = merge.merge_attempts(rows.where("attempt_id % 2 = 0"), rows.where("attempt_id % 2 = 1 or attempt_id % 10 = 0"), ["pk", "model"], "attempt_ts", "detailed_solution", "attempt_id")
    return merged.select("pk", "model", "attempt_id", "merged_from")


@query("SELECT topic_entry_id, string_agg(problem_key::varchar, ',' ORDER BY problem_key) AS problems FROM (SELECT DISTINCT topic_entry_id, problem_key FROM problem_metadata WHERE topic_entry_id IS NOT NULL) GROUP BY 1")
def assignment_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "problem_metadata").where("topic_entry_id is not null")
    both = merge.merge_assignment(rows.where("problem_key % 2 = 0"), rows.where("problem_key % 3 <= 2"), "topic_entry_id", "problem_key")
    return merge.ledger_documents(both, "topic_entry_id", "problem_key").select("topic_entry_id", F.array_join("problems", ",").alias("problems"))


@query("SELECT doc_id, topic_entry_id FROM documents WHERE topic_entry_id IN (SELECT topic_entry_id FROM topics WHERE topic_entry_id LIKE 'UG%') AND topic_entry_id NOT IN ('UG-01', 'UG-02')")
def topic_include_exclude(spark, sf_dir):
    include = [f"UG-{n:02d}" for n in range(100)]
    return table(spark, sf_dir, "documents").where(predicates.included(F.col("topic_entry_id"), include, ["UG-01", "UG-02"])).select("doc_id", "topic_entry_id")


NAMES = ("gpt-4.1", "gpt4", "o3-mini", "o4-mini", "deepseek-chat", "deepseek-ai/DeepSeek-R1-Distill-Qwen-7B", "claude-x", "gemini-2.5-flash", "moonshotai/Kimi", "grok-3", "openai/gpt-oss-20b", "openai/gpt-oss-120b", "meta/llama", "chatgpt-latest")
STARTS = " OR ".join(f"m LIKE '{p}%'" for ps in predicates.FAMILIES.values() for p in ps)


@query(f"SELECT m AS model_id, ({STARTS}) AND m NOT LIKE '{predicates.LOCAL_PREFIX}%' OR m IN {predicates.HOSTED} AS remote FROM (SELECT model_id AS m FROM model_registry UNION ALL SELECT unnest({list(NAMES)}))")
def model_routing(spark, sf_dir):
    names = table(spark, sf_dir, "model_registry").select("model_id").unionByName(spark.createDataFrame([(n,) for n in NAMES], "model_id string"))
    return names.select("model_id", predicates.is_remote(F.col("model_id")).alias("remote"))


@query("SELECT coalesce(max(try_cast(regexp_extract(problem_id || '.json', 'p(\\d+)\\.json$', 1) AS bigint)), 0) AS max_index FROM problem_metadata")
def max_problem_index(spark, sf_dir):
    from sievework.sources.readers import greatest_index

    return greatest_index(table(spark, sf_dir, "problem_metadata").select(F.concat("problem_id", F.lit(".json")).alias("file_path")))


@query("SELECT problem_id, topic_entry_id, date_added, greatest(coalesce(n, 0), 0)::bigint AS attempts FROM problem_metadata p LEFT JOIN (SELECT problem_key, count(*) AS n FROM model_solutions GROUP BY 1) USING (problem_key) WHERE coalesce(n, 0) < 3")
def resume_work(spark, sf_dir):
    made = table(spark, sf_dir, "model_solutions").groupBy("problem_key").agg(F.count(F.lit(1)).alias("n"))
    problems = table(spark, sf_dir, "problem_metadata").join(made, "problem_key", "left").withColumn("attempts", F.coalesce("n", F.lit(0)))
    return problems.where(predicates.to_resume(F.lit(False), F.col("attempts"), 3)).select("problem_id", "topic_entry_id", "date_added", "attempts")


# --- text -------------------------------------------------------------------------

#: Sections of a text in SQL: from each known heading to the next, the last of equal titles.
SECTIONS_SQL = rf"""
  parts AS (SELECT pair_id, k, part FROM (SELECT pair_id, unnest(string_split_regex(raw, '\\section\*?\{{')) AS part, unnest(range(1, len(string_split_regex(raw, '\\section\*?\{{')) + 1)) AS k FROM raws)),
  marked AS (SELECT pair_id, k, part, trim(split_part(part, '}}', 1)) AS title, k > 1 AND regexp_matches(part, '^\s*({'|'.join(T.TITLES)})\s*\}}') AS begins FROM parts),
  grouped AS (SELECT *, sum(begins::int) OVER (PARTITION BY pair_id ORDER BY k) AS g FROM marked),
  joined AS (SELECT pair_id, g, first(title ORDER BY k) AS title, string_agg(CASE WHEN begins THEN regexp_replace(part, '^[^}}]*\}}[^\n]*\n?', '') ELSE '\section{{' || part END, '' ORDER BY k) AS body FROM grouped WHERE g > 0 GROUP BY 1, 2),
  cleaned AS (SELECT pair_id, g, CASE title WHEN 'Problem' THEN 'Problem Statement' ELSE title END AS title, regexp_replace(regexp_replace(regexp_replace(body, '(?m)\\section\{{[^}}]+\}}\s*$', '', 'g'), '(?m)^```\w*\s*$', '', 'g'), '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS content FROM joined),
  sections AS (SELECT pair_id, title, arg_max(content, g) AS content FROM cleaned GROUP BY 1, 2)
"""


@query(f"""WITH raws AS (SELECT pair_id, '\\section{{Problem Statement}}' || chr(10) || coalesce(problem, '') || chr(10) || '\\section{{Answer}}' || chr(10) || pair_id || chr(10) || '\\section{{Answer}}' || chr(10) || (pair_id + 1) AS raw FROM matched_pairs), {SECTIONS_SQL}
  SELECT p.pair_id, s.content AS statement, a.content AS answer FROM matched_pairs p LEFT JOIN sections s ON s.pair_id = p.pair_id AND s.title = 'Problem Statement' LEFT JOIN sections a ON a.pair_id = p.pair_id AND a.title = 'Answer'""")
def parse_sections(spark, sf_dir):
    """Sections of every seed problem put under headings; headings and fences of its own are no sections."""
    key = F.col("pair_id").cast("string")
    raw = F.concat(F.lit("\\section{Problem Statement}\n"), F.coalesce("problem", F.lit("")), F.lit("\n\\section{Answer}\n"), key, F.lit("\n\\section{Answer}\n"), (F.col("pair_id") + 1).cast("string"))
    parts = T.sections(raw)
    return table(spark, sf_dir, "matched_pairs").select("pair_id", F.try_element_at(parts, F.lit("Problem Statement")).alias("statement"), F.try_element_at(parts, F.lit("Answer")).alias("answer"))


@query(r"""SELECT attempt_id, CASE WHEN len(f) > 0 THEN f[-1] ELSE e[-1] END AS code FROM (SELECT attempt_id, regexp_extract_all(detailed_solution, '(?s)```python\s*\n(.*?)```', 1) AS f, regexp_extract_all(detailed_solution, '(?s)\\begin\{python\}(.*?)\\end\{python\}', 1) AS e FROM model_solutions WHERE detailed_solution IS NOT NULL) WHERE len(f) > 0 OR len(e) > 0""")
def extract_code_last_block(spark, sf_dir):
    rows = table(spark, sf_dir, "model_solutions").where("detailed_solution is not null").select("attempt_id", T.last_code(F.col("detailed_solution")).alias("code"))
    return rows.where("code is not null")


@query(r"""SELECT attempt_id, regexp_extract(detailed_solution, 'def\s+(\w+)\s*\(', 1) AS name, len(regexp_extract_all(regexp_extract(detailed_solution, 'def\s+\w+\s*\(([^)]*)\)', 1), '\w+\s*:\s*\w+'))::bigint AS args, CASE WHEN regexp_extract(detailed_solution, '(?s)"""+'"""(.*?)"""'+r"""', 1) <> '' THEN regexp_extract(detailed_solution, '(?s)"""+'"""(.*?)"""'+r"""', 1) ELSE regexp_extract(detailed_solution, '(?s)''''''(.*?)''''''', 1) END AS doc FROM model_solutions WHERE regexp_matches(detailed_solution, 'def\s+\w+\s*\([^)]*\)\s*(?:->\s*[\w.\[\], ]+?)?\s*:')""")
def parse_signature(spark, sf_dir):
    rows = table(spark, sf_dir, "model_solutions").select("attempt_id", T.signature(F.col("detailed_solution")).alias("s"), T.docstring(F.col("detailed_solution")).alias("doc")).where("s is not null")
    return rows.select("attempt_id", "s.name", F.size("s.args").cast("bigint").alias("args"), "doc")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS int) AS k FROM events")
def parse_scores_json(spark, sf_dir):
    noisy = F.concat(F.lit("Here is the result:\n```json\n"), F.col("props"), F.lit("\n```"))
    found = F.from_json(T.object_text(noisy), "k int")
    return table(spark, sf_dir, "events").select("event_id", found["k"].alias("k"))


@query("SELECT event_id, CASE WHEN isfinite(x) THEN x END AS value, CASE WHEN lower(event_type) NOT IN ('inf', '-inf', 'nan', 'infinity', '-infinity') THEN event_type END AS event_type FROM (SELECT event_id, event_type, CASE event_id % 10 WHEN 3 THEN 'nan'::double WHEN 7 THEN 'inf'::double ELSE value END AS x FROM events)")
def scrub_non_finite(spark, sf_dir):
    x = F.when(F.pmod("event_id", F.lit(10)) == 3, F.lit(math.nan)).when(F.pmod("event_id", F.lit(10)) == 7, F.lit(math.inf)).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", compare.finite(x).alias("value"), compare.finite_text(F.col("event_type")).alias("event_type"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, abs(l_quantity - (l_quantity + (l_linenumber - 3) * 5e-7)) <= 1e-6 AS matches FROM lineitem")
def compare_outputs_scalar(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    other = F.col("l_quantity") + (F.col("l_linenumber") - 3) * F.lit(5e-7)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", compare.close(F.col("l_quantity"), other).alias("matches"))


@query("SELECT vec_id, count(*) FILTER (abs(x - y) <= 1e-3) = count(*) AS matches FROM (SELECT vec_id, unnest(embedding)::double AS x, unnest(embedding)::double + (vec_id % 3) * 6e-4 AS y FROM embeddings) GROUP BY 1")
def compare_outputs_list(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    own = F.transform("embedding", lambda x: x.cast("double"))
    moved = F.transform(own, lambda x: x + F.pmod("vec_id", F.lit(3)) * F.lit(6e-4))
    return rows.select("vec_id", compare.close_lists(own, moved, 1e-3).alias("matches"))


@query("SELECT event_id, NOT (CASE user_id % 3 WHEN 0 THEN abs(x) < 1e-9 WHEN 1 THEN x < 0 ELSE x <= 0 END) AS safe FROM (SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN 0.0 WHEN event_id % 5 = 1 THEN -value ELSE value END AS x FROM events)")
def input_safety(spark, sf_dir):
    x = F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit(0.0)).when(F.pmod("event_id", F.lit(5)) == 1, -F.col("value")).otherwise(F.col("value"))
    kind = F.element_at(F.array(F.lit("division_by_zero"), F.lit("negative_factorial"), F.lit("domain_error")), (F.pmod("user_id", F.lit(3)) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", predicates.safe_inputs(F.create_map(F.lit("x"), x), F.create_map(F.lit("x"), F.array(kind))).alias("safe"))


@query("SELECT topic_entry_id, 'Level: ' || coalesce(difficulty_level, '') || chr(10) || 'Topic: ' || coalesce(topic, '') || chr(10) || CASE WHEN length(description) > 60 THEN left(description, 60) || '...' ELSE coalesce(description, '') END AS prompt FROM topics")
def render_prompt(spark, sf_dir):
    made = T.prompt("Level: {{L}}\nTopic: {{T}}\n{{D}}", L=F.col("difficulty_level"), T=F.col("topic"), D=T.shortened(F.col("description"), 60))
    return table(spark, sf_dir, "topics").select("topic_entry_id", made.alias("prompt"))


@query()
def clean_cot(spark, sf_dir):
    return table(spark, sf_dir, "model_solutions").select("attempt_id", T.escaped_text(T.report_text(F.col("detailed_solution"))).alias("latex"))


@query("SELECT attempt_id, epoch_us(try_cast(attempt_ts AS timestamptz)) AS micros FROM model_solutions")
def attempt_times(spark, sf_dir):
    """Every attempt's time in microseconds; null where its text cannot be read."""
    return table(spark, sf_dir, "model_solutions").select("attempt_id", F.unix_micros(T.iso_time(F.col("attempt_ts"))).alias("micros"))


# --- documents, code, calls ---------------------------------------------------------


def opened(x: str) -> str:
    """SQL: a string that holds a JSON object or array stands for it."""
    inner = f"({x})->>'$'"
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND regexp_matches({inner}, '^\\s*[\\[{{]') AND json_valid({inner}) THEN ({inner})::JSON ELSE ({x}) END"


def listed(x: str) -> str:
    """SQL: positions and elements of an array; a single object is an array of one."""
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN from_json({x}, '[\"JSON\"]') WHEN 'OBJECT' THEN [{x}] ELSE []::JSON[] END"


def exploded(name: str, source: str, keys: str, array: str) -> str:
    """CTEs: a row (keys, pos, e) per element that is not null."""
    return f"""{name}_a AS (SELECT {keys}, {opened(array)} AS a FROM {source}),
      {name}_l AS (SELECT * EXCLUDE (a), {listed('a')} AS l FROM {name}_a),
      {name}_u AS (SELECT * EXCLUDE (l), unnest(l) AS x, unnest(range(len(l))) AS pos FROM {name}_l),
      {name} AS (SELECT * EXCLUDE (x), {opened('x')} AS e FROM {name}_u WHERE coalesce(json_type(x), 'NULL') <> 'NULL')"""


def member_sql(x: str, name: str) -> str:
    return f"CASE WHEN json_type({x}) = 'OBJECT' THEN json_extract({x}, '$.{name}') END"


#: The nested tables in SQL: broken documents are cut at the end of their first whole object.
NESTED_SQL = f"""
      ends AS (SELECT record_id, record_json, unnest(string_split(record_json, '}}')) AS part FROM problem_records WHERE NOT json_valid(record_json)),
      places AS (SELECT record_id, record_json, sum(length(part) + 1) OVER (PARTITION BY record_id ORDER BY rowid_ ROWS UNBOUNDED PRECEDING) AS upto FROM (SELECT *, row_number() OVER () AS rowid_ FROM ends)),
      cut AS (SELECT record_id, min_by(left(record_json, upto::bigint), upto) AS doc FROM places WHERE json_valid(left(record_json, upto::bigint)) GROUP BY 1),
      docs AS (SELECT record_id, record_json::JSON AS d FROM problem_records WHERE json_valid(record_json) UNION ALL SELECT record_id, doc::JSON FROM cut),
      top AS (SELECT record_id, d, {opened(member_sql('d', 'problem_details'))} AS details, {opened(member_sql('d', 'quality_gradings'))} AS grades FROM docs WHERE json_type(d) = 'OBJECT'),
      test AS (SELECT record_id, {opened(member_sql('details', 'test'))} AS test FROM top),
      {exploded('test_cases', 'test', 'record_id', member_sql('test', 'test_cases'))},
      inputs_a AS (SELECT record_id, pos, {opened(member_sql('e', 'inputs'))} AS i FROM test_cases),
      inputs_k AS (SELECT record_id, pos, i, unnest(json_keys(i)) AS k FROM inputs_a WHERE json_type(i) = 'OBJECT'),
      case_inputs AS (SELECT record_id, pos, k, json_extract(i, '$."' || k || '"') AS e FROM inputs_k),
      graders AS (SELECT record_id, k, json_extract(grades, '$."' || k || '"') AS g FROM (SELECT record_id, grades, unnest(json_keys(grades)) AS k FROM top WHERE json_type(grades) = 'OBJECT')),
      {exploded('gradings', 'graders', 'record_id, k', 'g')},
      {exploded('models', 'top', 'record_id', member_sql('d', 'model_solutions'))},
      {exploded('attempts', 'models', 'record_id, pos AS model_pos', member_sql('e', 'attempts'))},
      {exploded('verdicts_all', 'attempts', 'record_id, model_pos, pos AS attempt_pos', member_sql('e', 'verifier_result'))},
      verdicts AS (SELECT * FROM verdicts_all WHERE NOT (json_type(e) = 'OBJECT' AND len(json_keys(e)) = 0)),
      {exploded('verdict_cases', 'verdicts', 'record_id, model_pos, attempt_pos, pos AS verdict_pos', member_sql('e', 'test_cases'))}
"""
PATH = {
    "test_cases": ("''", "pos::varchar"), "case_inputs": ("pos::varchar", "k"), "gradings": ("k", "pos::varchar"), "models": ("''", "pos::varchar"), "attempts": ("model_pos::varchar", "pos::varchar"),
    "verdicts": ("model_pos || '/' || attempt_pos", "pos::varchar"), "verdict_cases": ("model_pos || '/' || attempt_pos || '/' || verdict_pos", "pos::varchar"),
}


def table_sql(tag: str, fields: str) -> str:
    parent, child = PATH[tag]
    return f"WITH {NESTED_SQL} SELECT record_id, {parent} AS parent_key, {child} AS child_key, {fields} FROM {tag}"


def of_type(name: str, kinds: str, cast: str) -> str:
    """SQL: a field where it is of one of the JSON types, else null."""
    return f"CASE WHEN json_type(json_extract(e, '$.{name}')) IN ({kinds}) THEN (e->>'$.{name}')::{cast} END AS {name}"


WHOLE, TEXT, REAL = "'BIGINT', 'UBIGINT'", "'VARCHAR'", "'BIGINT', 'UBIGINT', 'DOUBLE'"


@query("WITH " + NESTED_SQL + " " + " UNION ALL ".join(f"SELECT record_id, '{tag}' AS child_table, {parent} AS parent_key, {child} AS child_key FROM {tag}" for tag, (parent, child) in PATH.items()))
def p2_found(spark, sf_dir):
    return nested.found(table(spark, sf_dir, "problem_records"))


@query(table_sql("test_cases", ", ".join([of_type("case_id", WHOLE, "bigint"), of_type("output_type", TEXT, "varchar"), of_type("tolerance", REAL, "double")])))
def p2_test_cases(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "test_cases").select("record_id", "parent_key", "child_key", "case_id", "output_type", "tolerance")


@query(table_sql("case_inputs", "json_type(e) AS kind, CASE WHEN json_type(e) IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN (e->>'$')::double END AS number"))
def p2_case_inputs(spark, sf_dir):
    """Every input of a test case with its JSON type and, if it is one, its number."""
    inputs = nested.flattened(table(spark, sf_dir, "problem_records"), "case_inputs")
    v = F.col("value")
    number = v.rlike(r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$")
    kind = F.when(v.startswith("{"), "OBJECT").when(v.startswith("["), "ARRAY").when(v.startswith('"'), "VARCHAR").when(v == "null", "NULL").when(v.isin("true", "false"), "BOOLEAN").when(v.rlike(r"^-\d+$"), "BIGINT").when(v.rlike(r"^\d+$"), "UBIGINT").otherwise("DOUBLE")
    return inputs.select("record_id", "parent_key", "child_key", kind.alias("kind"), F.when(number, v.cast("double")).alias("number"))


@query(table_sql("gradings", ", ".join([of_type("index", WHOLE, "bigint"), of_type("timestamp", TEXT, "varchar"), *(of_type(n, WHOLE, "bigint") for n in ("problem_quality", "solution_completeness", "solution_quality", "test_case_quality", "seed_correspondence", "output_seed_correspondence")), of_type("problem_quality_comment", TEXT, "varchar")])))
def p2_gradings(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "gradings").select("record_id", "parent_key", "child_key", "index", "timestamp", "problem_quality", "solution_completeness", "solution_quality", "test_case_quality", "seed_correspondence", "output_seed_correspondence", "problem_quality_comment")


@query(table_sql("models", of_type("model", TEXT, "varchar")))
def p2_models(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "models").select("record_id", "parent_key", "child_key", "model")


@query(table_sql("attempts", ", ".join(of_type(n, TEXT, "varchar") for n in ("timestamp", "prompt_type", "detailed_solution"))))
def p2_attempts(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "attempts").select("record_id", "parent_key", "child_key", "timestamp", "prompt_type", "detailed_solution")


@query(table_sql("verdicts", ", ".join([of_type("verified", WHOLE, "bigint"), of_type("error", TEXT, "varchar"), of_type("timestamp", TEXT, "varchar")])))
def p2_verdicts(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "verdicts").select("record_id", "parent_key", "child_key", "verified", "error", "timestamp")


@query(table_sql("verdict_cases", ", ".join([of_type("standard_output", TEXT, "varchar"), "(e->>'$.matches')::boolean AS matches", of_type("tolerance_used", REAL, "double")])))
def p2_verdict_cases(spark, sf_dir):
    return nested.flattened(table(spark, sf_dir, "problem_records"), "verdict_cases").select("record_id", "parent_key", "child_key", "standard_output", "matches", "tolerance_used")


@query(f"WITH {NESTED_SQL}, t AS (SELECT record_id, e->>'$.output_type' AS output_type FROM test_cases WHERE json_type(json_extract(e, '$.output_type')) = 'VARCHAR') SELECT output_type, count(*) AS n, CASE WHEN count(*) < 20 THEN string_agg(DISTINCT record_id::varchar, ',' ORDER BY record_id::varchar) END AS problems FROM t GROUP BY 1")
def output_type_audit(spark, sf_dir):
    found = nested.flattened(table(spark, sf_dir, "problem_records"), "test_cases").where("output_type is not null")
    return verdicts.output_types(found)


def record_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.get_json_object(T.repaired_text("record_json"), "$.problem_details.Code")
    return table(spark, sf_dir, "problem_records").select("record_id", code.alias("code")).where("code is not null")


@query()
def synthesize_cases(spark, sf_dir):
    return cases.synthesize(record_functions(spark, sf_dir), "record_id", "code")


@query(f"WITH {NESTED_SQL} SELECT record_id, CASE WHEN regexp_matches(details->>'$.Code', '/ \\(\\w+ ') THEN regexp_extract(details->>'$.Code', '/ \\((\\w+) ', 1) || ':division_by_zero' ELSE '' END AS risks FROM top WHERE json_type(json_extract(details, '$.Code')) = 'VARCHAR'")
def unsafe_operations(spark, sf_dir):
    """Risks of each record's function by its own arguments."""

    @F.pandas_udf("array<string>")
    def risks(batch):
        import pandas as pd

        return pd.Series([[f"{a}:{r}" for a, rs in C.unsafe_operations(code, C.arguments(code)).items() for r in rs] for code in batch])

    return record_functions(spark, sf_dir).select("record_id", F.array_join(risks("code"), ",").alias("risks"))


def record_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_id, problem_key, code and cases made by rule, of every record that has a function."""
    functions = record_functions(spark, sf_dir)
    made = cases.synthesize(functions, "record_id", "code").groupBy(F.col("record_id").cast("bigint").alias("record_id")).agg(F.sort_array(F.collect_list(F.struct("case_id", "inputs"))).alias("cases"))
    return functions.join(made, "record_id").join(table(spark, sf_dir, "problem_records").select("record_id", "problem_key"), "record_id")


@query()
def execute_and_grade(spark, sf_dir):
    """Every record's function against itself, and against the code of each solver attempt at its problem, in child processes."""
    records = record_cases(spark, sf_dir)
    own = records.select("record_id", F.lit(None).cast("bigint").alias("attempt_id"), "code", F.col("code").alias("attempt"), "cases")
    found = table(spark, sf_dir, "model_solutions").select("attempt_id", "problem_key", T.last_code(F.col("detailed_solution")).alias("attempt")).where("attempt is not null")
    tried = own.unionByName(records.join(found, "problem_key").select("record_id", "attempt_id", "code", "attempt", "cases"))
    return cases.grade(tried, ["record_id", "attempt_id"], "code", "attempt", "cases", together=("record_id",)).select("record_id", "attempt_id", "verified", "error")


@query()
def execute_records(spark, sf_dir):
    """Every record's function on its own test cases, inputs converted to the types of its arguments."""
    stored = nested.flattened(table(spark, sf_dir, "problem_records"), "test_cases").groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct(F.col("child_key").cast("int").alias("case_id"), "inputs"))).alias("cases"))
    ran = cases.execute(record_functions(spark, sf_dir).join(stored, "record_id"), "record_id", "code", "cases")
    return ran.select("record_id", "error", F.size("results").alias("ran"))


@query()
def solve_loop_stub(spark, sf_dir):
    """Two attempts at every record's problem with the offline provider, graded by running them."""
    statement = F.get_json_object("record_json", "$.problem_details.Problem Statement")
    texts = table(spark, sf_dir, "problem_records").select("record_id", statement.alias("statement"))
    problems = record_cases(spark, sf_dir).join(texts, "record_id").select(F.col("record_id").cast("string").alias("problem_id"), "statement", "code", "cases")
    return pipeline.solve(problems, pipeline.Config(max_k=2))


@query("SELECT problem_key, 100 AS problem_quality, 100 AS solution_quality, NULL::varchar AS error FROM problem_metadata")
def grade_calls(spark, sf_dir):
    """One grading call per problem with the model that gives full marks."""
    problems = table(spark, sf_dir, "problem_metadata").select("problem_key", T.prompt("Grade:\n{{P}}", P=F.col("problem_description")).alias("prompt"), F.lit("test-model").alias("model"))
    scores = F.from_json(T.object_text("response"), "problem_quality int, solution_quality int")
    return call(problems, Stub(), "prompt", "model").select("problem_key", scores.alias("s"), "error").select("problem_key", "s.*", "error")
