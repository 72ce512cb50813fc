"""Queries of the stages' operators: prompts, plans, routing, merging, test cases, documents as files; each with SQL where SQL can say it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import code as C
from sievework.functions import text as T
from sievework.operators import allocate, compare, grades, merge, nested, predicates, verdicts
from sievework.operators.compare import rounded
from sievework.plans import cases, pipeline, prompts, report
from sievework.plans.providers import Stub, call_batches
from sievework.queries import COUNTS_SQL, LATEST_SQL, LEVELS, NESTED_SQL, SPACE, TOTAL, VERDICTS_SQL, generation_prompts, good_grades, latest_of, level_attempts, query, record_cases, record_functions, table, verdict_facts, whole_context
from sievework.session import scratch
from sievework.sources import readers, sinks

# --- routing and resuming -----------------------------------------------------------


@query(f"WITH {VERDICTS_SQL}, won AS (SELECT problem_key, max((verified = 1)::int) AS any_won, max((verified = 1 AND model = 'orbis-large')::int) AS one_won FROM verdicts GROUP BY 1) SELECT p.problem_key, CASE WHEN coalesce(any_won, 0) = 1 THEN 'ok' ELSE 'solver_failed' END AS status, CASE WHEN coalesce(one_won, 0) = 1 THEN 'ok' ELSE 'solver_failed' END AS status_one FROM problem_metadata p LEFT JOIN won USING (problem_key)")
def solver_routing(spark, sf_dir):
    """Every problem routed by whether any model, or one model, solved it."""
    per = verdict_facts(spark, sf_dir).groupBy("problem_key", "model").agg(F.coalesce(F.max(F.col("verified") == 1), F.lit(False)).alias("passed"))
    results = per.groupBy("problem_key").agg(F.map_from_entries(F.collect_list(F.struct("model", F.struct("passed")))).alias("results"))
    routed = table(spark, sf_dir, "problem_metadata").select("problem_key").join(results, "problem_key", "left")
    routed = predicates.with_status(routed, predicates.solved(F.col("results")), "solver_failed")
    return predicates.with_status(routed, predicates.solved(F.col("results"), "orbis-large"), "solver_failed", "status_one").select("problem_key", "status", "status_one")


@query(f"WITH {VERDICTS_SQL}, have AS (SELECT DISTINCT attempt_id FROM verdicts) SELECT attempt_id, attempt_id NOT IN (SELECT attempt_id FROM have) AS due FROM model_solutions WHERE problem_key IS NOT NULL")
def regrade_work(spark, sf_dir):
    """Attempts that have no verdict yet."""
    rows = table(spark, sf_dir, "model_solutions").where("problem_key is not null")
    return rows.select("attempt_id", predicates.to_regrade(verdicts.normalise(F.col("verifier_result"))).alias("due"))


@query(f"WITH {NESTED_SQL} SELECT record_id, coalesce(json_type(test), 'NULL') = 'NULL' AS lacks, coalesce(json_type(test), 'NULL') <> 'NULL' AS updates FROM test")
def test_stage_work(spark, sf_dir):
    """Which records a test stage reads: those without tests, or those with tests when outputs are updated."""
    text = T.repaired_text("record_json")
    test = F.get_json_object(text, "$.problem_details.test")
    rows = table(spark, sf_dir, "problem_records").where(text.isNotNull())
    return rows.select("record_id", predicates.lacks_tests(test).alias("lacks"), predicates.lacks_tests(test, update=True).alias("updates"))


FAMILY_CASES = " ".join(f"WHEN {' OR '.join(f'm LIKE {chr(39)}{p}%{chr(39)}' for p in starts)} THEN '{name}'" for name, starts in predicates.FAMILIES.items())
SOME_NAMES = ("gpt-4.1", "o3-mini", "deepseek-chat", "deepseek-ai/DeepSeek-R1-Distill-Qwen-7B", "claude-x", "gemini-2", "moonshotai/Kimi", "grok-3", "openai/gpt-oss-120b", "openai/gpt-oss-20b")


@query(f"SELECT m AS model_id, CASE WHEN m LIKE '{predicates.LOCAL_PREFIX}%' THEN 'local' WHEN m IN {predicates.HOSTED} THEN 'hosted' {FAMILY_CASES} ELSE 'local' END AS family, ({' OR '.join(f'm LIKE {chr(39)}{p}%{chr(39)}' for p in predicates.SHARED_HOST)}) AND m NOT LIKE '{predicates.LOCAL_PREFIX}%' AS shared FROM (SELECT model_id AS m FROM model_registry UNION ALL SELECT unnest({list(SOME_NAMES)}))")
def model_families(spark, sf_dir):
    names = table(spark, sf_dir, "model_registry").select("model_id").unionByName(spark.createDataFrame([(n,) for n in SOME_NAMES], "model_id string"))
    return names.select("model_id", predicates.family(F.col("model_id")).alias("family"), predicates.on_shared_host(F.col("model_id")).alias("shared"))


@query(f"WITH {VERDICTS_SQL}, r AS (SELECT problem_key, model, count(*) AS runs FROM verdicts GROUP BY 1, 2) SELECT p.problem_key, coalesce(runs, 0)::bigint AS runs FROM problem_metadata p LEFT JOIN r ON r.problem_key = p.problem_key AND r.model = 'orbis-mini'")
def existing_result(spark, sf_dir):
    """A model's result looked up in the map of each problem, 0 where there is none."""
    counts = verdict_facts(spark, sf_dir).groupBy("problem_key", "model").agg(F.count(F.lit(1)).alias("runs"))
    maps = counts.groupBy("problem_key").agg(F.map_from_entries(F.collect_list(F.struct("model", "runs"))).alias("m"))
    return table(spark, sf_dir, "problem_metadata").select("problem_key").join(maps, "problem_key", "left").select("problem_key", F.coalesce(F.try_element_at("m", F.lit("orbis-mini")), F.lit(0)).cast("bigint").alias("runs"))


@query(f"WITH {VERDICTS_SQL}, r AS (SELECT problem_key, coalesce(max((verified = 1 AND attempt_ord <= 3)::int), 0) AS won, max(attempt_ord) AS used FROM verdicts WHERE model = 'orbis-large' GROUP BY 1) SELECT p.problem_key FROM problem_metadata p LEFT JOIN r USING (problem_key) WHERE coalesce(won, 0) = 0 AND coalesce(used, 0) < 3")
def resume_solver(spark, sf_dir):
    """Problems a solver has neither solved nor used its three attempts on."""
    mine = verdict_facts(spark, sf_dir).where("model = 'orbis-large'")
    results = mine.groupBy("problem_key").agg(F.max((F.col("verified") == 1) & (F.col("attempt_ord") <= 3)).alias("passed"), F.max("attempt_ord").alias("used"))
    return table(spark, sf_dir, "problem_metadata").select("problem_key").join(results, "problem_key", "left").where(predicates.to_resume(F.col("passed"), F.col("used"), 3)).select("problem_key")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_quantity IN (1, 2, 3, 5, 8, 13, 21, 34) AND l_linenumber > 0 AS safe FROM lineitem")
def allowed_inputs(spark, sf_dir):
    """Inputs against the values an argument may have, and against the risks of another."""
    inputs = F.create_map(F.lit("q"), F.col("l_quantity").cast("double"), F.lit("n"), F.col("l_linenumber").cast("double"))
    allowed = F.create_map(F.lit("q"), F.array(*(F.lit(float(x)) for x in (1, 2, 3, 5, 8, 13, 21, 34))))
    risks = F.create_map(F.lit("n"), F.array(F.lit("domain_error")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", predicates.safe_inputs(inputs, risks, allowed).alias("safe"))


# --- grades -------------------------------------------------------------------------


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, CASE WHEN problem_quality IS NOT NULL THEN 'older-model' END AS new_model, problem_quality AS score, coalesce(solution_quality, test_case_quality) AS renamed FROM latest")
def legacy_grades(spark, sf_dir):
    """Flat grades of the older form become grade 0 of a model; a renamed field is read by either name."""
    flat = F.when(F.col("problem_quality").isNotNull(), F.struct("problem_quality"))
    kind = "map<string,array<struct<index:int,timestamp:string,problem_quality:int>>>"
    documents = latest_of(spark, sf_dir).select("problem_key", "grader_id", flat.alias("quality"), F.lit(None).cast(kind).alias("quality_gradings"), grades.renamed("solution_quality", "test_case_quality").alias("renamed"))
    moved = grades.migrate_legacy(documents, "older-model", F.lit("unknown"))
    first = F.try_element_at(F.map_entries("quality_gradings"), F.lit(1))
    return moved.select("problem_key", "grader_id", first["key"].alias("new_model"), first["value"][0]["problem_quality"].alias("score"), "renamed")


@query("SELECT problem_key, grader_id, count(*) AS n, string_agg(run_index::varchar, ',' ORDER BY run_index, grade_row_id) AS runs FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL AND run_index IS NOT NULL GROUP BY 1, 2")
def sorted_grades(spark, sf_dir):
    """All grades of a problem by a grader in the order of their index."""
    rows = good_grades(spark, sf_dir).where("run_index is not null")
    listed = F.sort_array(F.collect_list(F.struct("run_index", "grade_row_id")))
    return rows.groupBy("problem_key", "grader_id").agg(F.count(F.lit(1)).alias("n"), listed.alias("g")).select("problem_key", "grader_id", "n", F.array_join(F.col("g")["run_index"].cast("array<string>"), ",").alias("runs"))


@query("""WITH base AS (SELECT problem_key, grader_id, grade_row_id, run_index FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL AND loaded_at < '2025-01-01'),
  new AS (SELECT problem_key, grader_id, grade_row_id FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL AND (loaded_at >= '2025-01-01' OR loaded_at IS NULL)),
  starts AS (SELECT problem_key, grader_id, max(run_index) AS s FROM base GROUP BY 1, 2)
  SELECT problem_key, grader_id, grade_row_id, run_index FROM base UNION ALL
  SELECT problem_key, grader_id, grade_row_id, (coalesce(s, -1) + row_number() OVER (PARTITION BY problem_key, grader_id ORDER BY grade_row_id))::int FROM new LEFT JOIN starts USING (problem_key, grader_id)""")
def append_grades(spark, sf_dir):
    """Grades of a later load numbered on from those there were."""
    rows = good_grades(spark, sf_dir).select("problem_key", "grader_id", "grade_row_id", "run_index", F.coalesce(F.col("loaded_at") >= "2025-01-01", F.lit(True)).alias("late"))
    return grades.append(rows.where("not late").drop("late"), rows.where("late").drop("late"), ["problem_key", "grader_id"], "run_index", ["grade_row_id"])


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, coalesce(problem_quality >= 70 AND solution_quality >= 70, false) AND (problem_quality_comment IS NULL OR coalesce(test_case_quality >= 70, false)) AS passed FROM latest")
def qc_filter_optional(spark, sf_dir):
    """The filter with a metric that counts only where its key is there: present but low, or null, fails; absent passes."""
    optional = F.when(F.col("problem_quality_comment").isNull(), True).otherwise(F.coalesce(F.col("test_case_quality") >= 70, F.lit(False)))
    return latest_of(spark, sf_dir).select("problem_key", "grader_id", grades.passes(("problem_quality", "solution_quality"), 0.7, optional).alias("passed"))


@query("SELECT pair_id, seed_type IS NOT NULL AS due FROM matched_pairs WHERE seed_type IS NOT NULL AND pair_id NOT IN (SELECT problem_key FROM quality_grades WHERE problem_key IS NOT NULL AND loaded_at < '2024-06-01')")
def seed_only_work(spark, sf_dir):
    """Documents with a seed that no grade of its correspondence exists for."""
    graded = table(spark, sf_dir, "quality_grades").where("problem_key is not null and loaded_at < timestamp'2024-06-01'").groupBy(F.col("problem_key").alias("pair_id")).agg(F.lit(1).alias("seed_correspondence"))
    docs = table(spark, sf_dir, "matched_pairs").select("pair_id", F.when(F.col("seed_type").isNotNull(), F.struct("seed_type")).alias("original_seed")).join(graded, "pair_id", "left")
    due = grades.seed_only_due(docs.withColumn("quality", F.struct("seed_correspondence")))
    return due.select("pair_id", F.col("original_seed").isNotNull().alias("due"))


@query("SELECT pair_id, '\\section{' || coalesce(seed_type, '') || '}' AS head, contains(coalesce(problem, ''), '<think>') AS thinks FROM matched_pairs")
def report_sections(spark, sf_dir):
    """A section of the report for every seed pair: its heading, and whether thoughts were dropped from it."""
    rows = table(spark, sf_dir, "matched_pairs")
    made = report.problem_sections(rows.withColumn("seed_type", F.coalesce("seed_type", F.lit(""))), F.col("seed_type"), F.col("problem"), F.col("solution"), keep=("pair_id", "problem"))
    return made.select("pair_id", F.substring_index("section", "\n", 1).alias("head"), F.coalesce(F.col("problem").contains("<think>"), F.lit(False)).alias("thinks"))


# --- merging --------------------------------------------------------------------------


@query("""WITH r AS (SELECT model, attempt_ts, min_by(verifier_result, attempt_id) AS v FROM model_solutions WHERE verifier_result IS NOT NULL AND attempt_ts IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2)
  SELECT attempt_id, CASE WHEN row_number() OVER (PARTITION BY m.model, m.attempt_ts ORDER BY attempt_id) = 1 THEN v END AS verdict FROM model_solutions m LEFT JOIN r ON r.model = m.model AND r.attempt_ts = m.attempt_ts""")
def attach_verdicts(spark, sf_dir):
    """Verdicts brought back to the first attempt of their model and time."""
    rows = table(spark, sf_dir, "model_solutions")
    results = rows.where("attempt_ts is not null and model is not null").select("model", "attempt_ts", F.col("attempt_id").alias("at"), F.col("verifier_result").alias("verdict"))
    tried = rows.select("attempt_id", "model", "attempt_ts", F.col("attempt_id").alias("at"))
    return merge.attach_verdicts(tried, results, ["model", "attempt_ts"], "verdict", "at").select("attempt_id", "verdict")


@query(r"""SELECT attempt_id, list_aggregate([a[i] || '=' || b[i] for i in range(1, least(len(a), len(b)) + 1)], 'string_agg', ';') AS pairs, least(len(a), len(b))::int AS n FROM (SELECT attempt_id, regexp_extract_all(detailed_solution, '([0-9]+)\.[0-9]+', 1) AS a, regexp_extract_all(detailed_solution, '\$([A-Za-z]+)\$', 1) AS b FROM model_solutions WHERE detailed_solution IS NOT NULL) WHERE least(len(a), len(b)) > 0""")
def zipped_positions(spark, sf_dir):
    """Two lists of a text joined by position, as long as the shorter."""
    found = table(spark, sf_dir, "model_solutions").where("detailed_solution is not null").select("attempt_id", F.regexp_extract_all("detailed_solution", F.lit(r"([0-9]+)\.[0-9]+"), F.lit(1)).alias("a"), F.regexp_extract_all("detailed_solution", F.lit(r"\$([A-Za-z]+)\$"), F.lit(1)).alias("b"))
    both = merge.zipped(F.col("a"), F.col("b"))
    return found.select("attempt_id", F.array_join(F.transform(both, lambda x: F.concat(x["a"], F.lit("="), x["b"])), ";").alias("pairs"), F.size(both).alias("n")).where("n > 0")


@query("SELECT event_id, json_keys(props) = ['k'] AS same FROM events")
def same_keys(spark, sf_dir):
    """Whether the properties of an event have just the key they should."""
    held = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", merge.same_keys(held, F.create_map(F.lit("k"), F.lit(""))).alias("same"))


@query(f"WITH {NESTED_SQL}, n AS (SELECT record_id, count(*) AS n FROM test_cases GROUP BY 1) SELECT p.record_id, coalesce(n, 0)::int AS now, (coalesce(n, 0) > 0)::int AS kept, (coalesce(n, 0) > 0)::int * 2 AS kept_twice FROM problem_records p LEFT JOIN n USING (record_id)")
def case_history(spark, sf_dir):
    """The test cases of a record pushed to its history, once and again."""
    found = nested.flattened(table(spark, sf_dir, "problem_records"), "test_cases").groupBy("record_id").agg(F.sort_array(F.collect_list("child_key")).alias("test_cases"))
    rows = table(spark, sf_dir, "problem_records").select("record_id").join(found, "record_id", "left").withColumn("test_cases", F.coalesce("test_cases", F.array().cast("array<string>"))).withColumn("history", F.array().cast("array<array<string>>"))
    once = rows.withColumn("history", merge.push_history("test_cases", "history"))
    twice = merge.push_history("test_cases", "history")
    return once.select("record_id", F.size("test_cases").alias("now"), F.size("history").alias("kept"), F.size(twice).alias("kept_twice"))


# --- text -----------------------------------------------------------------------------


@query(r"""SELECT attempt_id, regexp_replace(regexp_extract(detailed_solution, '(?s)```python\s*\n(.*?)```', 1), '^\n+', '') AS fence, CASE WHEN regexp_extract(detailed_solution, '(?s)\\begin\{python\}(.*?)\\end\{python\}', 1) <> '' THEN 'env' WHEN regexp_matches(detailed_solution, '(?s)```python\s*\n(.*?)```') THEN 'fence' ELSE 'none' END AS source FROM model_solutions WHERE detailed_solution IS NOT NULL""")
def first_code(spark, sf_dir):
    """The first code of each attempt: of an environment, else of a fence."""
    text = F.col("detailed_solution")
    rows = table(spark, sf_dir, "model_solutions").where("detailed_solution is not null")
    fence, code = T.first_fence(text), T.first_code(text)
    return rows.select("attempt_id", fence.alias("fence"), F.when(T.first_env(text) != "", "env").when(code != "", "fence").otherwise("none").alias("source"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size::int WHEN p_size % 3 = 1 THEN (p_size + 1)::int END AS size FROM part")
def tuple_sizes(spark, sf_dir):
    """Sizes that docstrings state for a tuple argument, in several forms."""
    n = F.col("p_size").cast("string")
    doc = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("k: an index. coords: a "), n, F.lit("-element tuple of floats."))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("coords: tuple with "), (F.col("p_size") + 1).cast("string"), F.lit(" elements, all real."))).otherwise("coords: numbers")
    return table(spark, sf_dir, "part").select("p_partkey", T.tuple_size(doc, "coords").alias("size"))


@query("SELECT doc_id, md5(list_aggregate([CASE WHEN length(l) = 0 THEN '' ELSE list_aggregate([substring(l, (k + 1)::bigint, 85) for k in range(0, length(l), 85)], 'string_agg', chr(10)) END for l in string_split(text, chr(10))], 'string_agg', chr(10))) AS wrapped FROM documents WHERE text IS NOT NULL")
def wrapped_lines(spark, sf_dir):
    """Texts with lines of 85 characters at most."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.md5(T.wrapped_text("text")).alias("wrapped"))


# --- prompts --------------------------------------------------------------------------


@query(f"""WITH {COUNTS_SQL},
  r AS (SELECT difficulty_level AS level, topic_entry_id, row_number() OVER (PARTITION BY difficulty_level ORDER BY topic_ord) - 1 AS slot, count(*) OVER (PARTITION BY difficulty_level) AS size FROM topics),
  t AS (SELECT level, level_ord, unnest(range(0, n)) AS turn FROM counts),
  work AS (SELECT t.level, topic_entry_id, row_number() OVER (ORDER BY level_ord, turn) AS problem_no FROM t JOIN r ON t.level = r.level AND turn % size = slot),
  seen AS (SELECT topic_entry_id, string_agg(position || '. ' || problem_description, chr(10) ORDER BY position) AS l FROM (SELECT topic_entry_id, problem_description, row_number() OVER (PARTITION BY topic_entry_id ORDER BY problem_key) AS position FROM problem_metadata WHERE topic_entry_id IS NOT NULL AND trim(problem_description) <> '') GROUP BY 1)
  SELECT w.level, w.topic_entry_id AS topic_id, problem_no, md5('Topic: ' || coalesce(topic, '') || chr(10) || coalesce(description, '') || chr(10) || 'Ask for exactly one task.' || coalesce(chr(10) || chr(10) || 'Previously generated problems in this topic:' || chr(10) || l || chr(10) || chr(10) || 'Make a problem with tasks that differ from those listed; some similarity is acceptable, a copy is not.', '')) AS prompt_hash
  FROM work w JOIN topics USING (topic_entry_id) LEFT JOIN seen USING (topic_entry_id)""")
def context_prompts(spark, sf_dir):
    """Every generation prompt with its whole running context, by its hash."""
    return generation_prompts(spark, sf_dir).select("level", "topic_id", "problem_no", F.md5("prompt").alias("prompt_hash"))


@query("SELECT pair_id, md5('S' || chr(10) || chr(10) || CASE WHEN seed_type = 'example' THEN 'Use the example below as a model of form; choose another subject.' ELSE 'Adapt the problem and solution below into a new problem with one answer.' END || chr(10) || chr(10) || 'Problem: ' || coalesce(problem, '') || chr(10) || 'Solution: ' || coalesce(solution, '')) AS prompt_hash FROM matched_pairs")
def adapted_prompts(spark, sf_dir):
    made = prompts.adapted(F.lit("S"), F.col("seed_type"), prompts.seed_text(F.col("problem"), F.col("solution")))
    return table(spark, sf_dir, "matched_pairs").select("pair_id", F.md5(made).alias("prompt_hash"))


@query("SELECT pair_id, md5('Grade seed_correspondence from 0 to 100 as JSON. ' || CASE WHEN seed_type = 'example' THEN 'Compare form and difficulty; the subject should differ.' ELSE 'Compare content; the adapted problem should follow from the seed.' END || chr(10) || chr(10) || 'INSTRUCTIONS OF THE GENERATION' || chr(10) || CASE WHEN length(solution) > 2000 THEN left(solution, 2000) || '...' ELSE coalesce(solution, '') END || chr(10) || chr(10) || 'SEED' || chr(10) || coalesce(problem, '') || chr(10) || chr(10) || 'PROBLEM' || chr(10) || coalesce(problem, '')) AS prompt_hash FROM matched_pairs")
def correspondence_prompts(spark, sf_dir):
    made = prompts.correspondence(F.col("solution"), F.col("seed_type"), F.col("problem"), F.col("problem"))
    return table(spark, sf_dir, "matched_pairs").select("pair_id", F.md5(made).alias("prompt_hash"))


RUBRIC_TEXT = "Grade from 0 to 100, each with a short comment under the same name with _comment. Answer with one JSON object.\n" + "\n".join(f"- {k}: {v}" for k, v in prompts.RUBRIC.items())
MORE_TEXT = "\n".join(f"- {k}: {v}" for k, v in prompts.SEED_RUBRIC.items())


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"SELECT pair_id, md5({quoted(RUBRIC_TEXT)} || CASE WHEN arxiv_id IS NOT NULL THEN {quoted(chr(10) + MORE_TEXT)} ELSE '' END || {quoted(chr(10) * 2 + 'PROBLEM' + chr(10))} || coalesce(problem, '') || {quoted(chr(10) * 2 + 'SOLUTION' + chr(10))} || coalesce(solution, '') || {quoted(chr(10) * 2 + 'ANSWER' + chr(10) * 3 + 'CODE' + chr(10) * 3 + 'TEST CASES' + chr(10) + 'none')} || CASE WHEN arxiv_id IS NOT NULL THEN {quoted(chr(10) * 2 + 'SEED' + chr(10))} || arxiv_id ELSE '' END) AS prompt_hash FROM matched_pairs")
def grading_prompts(spark, sf_dir):
    """The rubric for every pair, with its seed where there is one."""
    none = F.lit(None).cast("string")
    no_cases = prompts.shown_cases(F.lit(None).cast("array<struct<inputs:string,output:string>>"))
    made = prompts.grading(F.col("problem"), F.col("solution"), none, none, no_cases, F.col("arxiv_id"))
    return table(spark, sf_dir, "matched_pairs").select("pair_id", F.md5(made).alias("prompt_hash"))


@query(f"WITH {NESTED_SQL}, s AS (SELECT record_id, string_agg((pos + 1) || '. ' || coalesce(e->>'$.output_type', '') || ' -> ' || CASE WHEN json_type(json_extract(e, '$.tolerance')) IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'close' ELSE '?' END, chr(10) ORDER BY pos) AS shown, count(*) AS n, max(pos) AS last FROM test_cases GROUP BY 1) SELECT record_id, shown FROM s WHERE n = last + 1")
def shown_cases(spark, sf_dir):
    """The test cases of each record as numbered lines, where none of them is null."""
    found = nested.flattened(table(spark, sf_dir, "problem_records"), "test_cases")
    one = F.struct(F.col("child_key").cast("int").alias("pos"), F.col("output_type").alias("inputs"), F.when(F.col("tolerance").isNotNull(), "close").alias("output"))
    lists = found.groupBy("record_id").agg(F.array_sort(F.collect_list(one)).alias("c")).where("size(c) = element_at(c, -1).pos + 1")
    return lists.select("record_id", prompts.shown_cases(F.col("c")).alias("shown"))


@query(r"""SELECT attempt_id, md5('Reasoning: high' || chr(10) || coalesce(prompt_type, '') || chr(10) || chr(10) || chr(10) || chr(10) || 'Give a python function ' || coalesce(name, 'f') || ' in a fence.' || chr(10) || 'Attempt ' || coalesce(attempt_no, 0)) AS prompt_hash
  FROM (SELECT *, CASE WHEN regexp_matches(detailed_solution, 'def\s+\w+\s*\([^)]*\)\s*(?:->\s*[\w.\[\], ]+?)?\s*:') THEN regexp_extract(detailed_solution, 'def\s+(\w+)\s*\(([^)]*)\)\s*(?:->\s*[\w.\[\], ]+?)?\s*:', 1) || '(' || coalesce(list_aggregate([regexp_replace(a, '\s*:\s*', ': ') for a in regexp_extract_all(regexp_extract(detailed_solution, 'def\s+\w+\s*\(([^)]*)\)\s*(?:->\s*[\w.\[\], ]+?)?\s*:', 1), '\w+\s*:\s*\w+')], 'string_agg', ', '), '') || ')' END AS name FROM model_solutions)""")
def solving_prompts(spark, sf_dir):
    """Solver prompts that ask for a function of the signature found in each text."""
    made = prompts.solving(F.col("prompt_type"), F.lit(None).cast("string"), F.col("detailed_solution"), F.coalesce("attempt_no", F.lit(0)), F.lit("high"))
    return table(spark, sf_dir, "model_solutions").select("attempt_id", F.md5(made).alias("prompt_hash"))


# --- limits and reports -----------------------------------------------------------------


@query("SELECT doc_id, source FROM documents ORDER BY md5('1:' || doc_id), doc_id LIMIT 5")
def sample_preview(spark, sf_dir):
    """Five documents to look at, the same on every run."""
    return allocate.preview(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


@query(f"WITH {VERDICTS_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY problem_key, model, attempt_ord ORDER BY attempt_id) AS k FROM verdicts WHERE attempt_ord <= 2), rate AS (SELECT problem_key, model, avg(CASE WHEN verified = 1 THEN 1.0 ELSE 0.0 END) AS accuracy FROM f GROUP BY 1, 2) SELECT f.problem_key, f.model, f.attempt_ord, round(accuracy, 9) AS accuracy FROM f JOIN rate USING (problem_key, model) WHERE verified = 1")
def correct_attempts(spark, sf_dir):
    """Right attempts among the first two of each model, best models first."""
    return report.selected_attempts(verdict_facts(spark, sf_dir), 2, True).select("problem_key", "model", "attempt_ord", F.round("accuracy", 9).alias("accuracy"))


@query(f"WITH {VERDICTS_SQL}, l AS (SELECT p.problem_key, coalesce(t.difficulty_level, 'Unknown') AS level FROM problem_metadata p LEFT JOIN topics t USING (topic_entry_id)) SELECT level, model, round(avg(verified), 9) AS mean_score, count(DISTINCT problem_key) AS sample_size FROM verdicts JOIN l USING (problem_key) GROUP BY 1, 2")
def report_levels(spark, sf_dir):
    """The report's table of models by level."""
    return report_tables(spark, sf_dir)["Models by level"].withColumn("mean_score", F.round("mean_score", 9))


def report_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    levels = level_attempts(spark, sf_dir).select("attempt_id", "level")
    facts = verdict_facts(spark, sf_dir).join(levels, "attempt_id")
    return report.evaluation(facts, levels)


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'null' ELSE value::varchar END = 'null' AS scrubbed FROM events")
def scrub_nested(spark, sf_dir):
    """Numbers and names of numbers that are not finite, at any depth of a JSON text, as null."""
    k = F.pmod("event_id", F.lit(4))
    inner = F.when(k == 0, F.lit("NaN")).when(k == 1, F.lit('"-Infinity"')).otherwise(F.col("value").cast("string"))
    text = F.concat(F.lit('{"a": [{"b": '), inner, F.lit("}]}"))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(compare.scrubbed_json(text), "$.a[0].b").isNull().alias("scrubbed"))


# --- documents as files -------------------------------------------------------------------


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record written as a file of its folder by status, and read back."""
    folder = scratch(spark, "documents").removeprefix("file://")
    rows = table(spark, sf_dir, "problem_records").where("record_json is not null").select(F.concat(F.coalesce("status_dir", F.lit("ok")), F.lit("/p"), "record_id").alias("name"), "record_json")
    sinks.export_texts(rows, folder, "name", "record_json")
    return readers.documents(spark, folder, recursive=True)


@query(f"WITH {NESTED_SQL} SELECT coalesce(status_dir, 'ok') AS status_dir, p.record_id, d->>'$.problem_id' AS problem_id, d->>'$.problem_metadata.\"Topic Entry ID\"' AS topic_id FROM top JOIN problem_records p USING (record_id) WHERE d->>'$.problem_id' IS NOT NULL")
def document_files(spark, sf_dir):
    """Documents through files: folders by status, text after a document's end cut off, broken ones left out."""
    docs = stored_documents(spark, sf_dir)
    number = F.regexp_extract(readers.stem(F.col("file_path")), r"p(\d+)$", 1).cast("bigint")
    return docs.select("status_dir", number.alias("record_id"), "problem_id", F.try_element_at("problem_metadata", F.lit("Topic Entry ID")).alias("topic_id"))


@query(f"WITH {NESTED_SQL} SELECT count(*) AS broken FROM problem_records WHERE record_json IS NOT NULL AND record_id NOT IN (SELECT record_id FROM top WHERE d->>'$.problem_id' IS NOT NULL)")
def broken_files(spark, sf_dir):
    """Files that hold no readable document."""
    folder = scratch(spark, "documents").removeprefix("file://")
    sinks.export_texts(table(spark, sf_dir, "problem_records").where("record_json is not null").select(F.concat(F.lit("p"), "record_id").alias("name"), "record_json"), folder, "name", "record_json")
    return readers.broken_documents(spark, folder).agg(F.count(F.lit(1)).alias("broken"))


@query("SELECT topic_entry_id AS topic_id, string_agg(n::varchar, ',' ORDER BY n) AS problems FROM (SELECT DISTINCT topic_entry_id, problem_key::int AS n FROM problem_metadata WHERE topic_entry_id IS NOT NULL) GROUP BY 1")
def ledger_file(spark, sf_dir):
    """A ledger written as one JSON document and read back."""
    rows = table(spark, sf_dir, "problem_metadata").where("topic_entry_id is not null")
    path = scratch(spark, "ledger")
    sinks.ledger_json(merge.ledger_documents(rows, "topic_entry_id", "problem_key"), "topic_entry_id", "problems").write.text(path)
    back = readers.assignment(spark, path)
    return back.groupBy("topic_id").agg(F.array_join(F.sort_array(F.collect_set("problem_no")).cast("array<string>"), ",").alias("problems"))


@query("SELECT difficulty_level AS level, dense_rank() OVER (ORDER BY level_ord)::int - 1 AS level_ord, subcategory, topic_entry_id AS id, topic, description FROM topics")
def topic_file(spark, sf_dir):
    """The topic list written as one nested JSON document and read back."""
    rows = table(spark, sf_dir, "topics")
    entry = F.struct("topic_ord", F.col("topic_entry_id").alias("id"), "topic", "description")
    by_group = rows.groupBy("level_ord", "difficulty_level", "subcategory").agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.min("topic_ord").alias("first"))
    by_level = by_group.groupBy("level_ord", "difficulty_level").agg(F.sort_array(F.collect_list(F.struct("first", "subcategory", "entries"))).alias("groups"))
    maps = by_level.select("level_ord", "difficulty_level", F.map_from_entries(F.transform("groups", lambda g: F.struct(g["subcategory"], g["entries"]))).alias("m"))
    whole = maps.agg(F.array_sort(F.collect_list(F.struct("level_ord", "difficulty_level", F.to_json("m").alias("j")))).alias("l"))
    text = F.concat(F.lit("{"), F.array_join(F.transform("l", lambda x: F.concat(F.to_json(F.struct(x["difficulty_level"].alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(x["difficulty_level"].alias("k")))) - 6), F.lit(": "), x["j"])), ", "), F.lit("}"))
    path = scratch(spark, "topics")
    whole.select(text.alias("value")).write.text(path)
    return readers.topics(spark, path).select("level", "level_ord", "subcategory", "id", "topic", "description")


@query("SELECT count(DISTINCT problem_key) AS logged FROM quality_grades WHERE problem_key IS NOT NULL")
def unique_log(spark, sf_dir):
    """A log of problems written in two overlapping loads; each is logged once."""
    rows = table(spark, sf_dir, "quality_grades").where("problem_key is not null").select("problem_key")
    path = scratch(spark, "log")
    for part in (rows.where("problem_key % 2 = 0"), rows):
        merge.append_log(part, path, ["problem_key"])
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("logged"))


@query(f"WITH {NESTED_SQL}, d AS (SELECT d->>'$.problem_metadata.\"Topic Entry ID\"' AS topic_id, try_cast(regexp_extract(d->>'$.problem_id', '(\\d+)$', 1) AS int) AS n FROM top) SELECT topic_id, string_agg(DISTINCT n::varchar, ',' ORDER BY n::varchar) AS problems FROM d WHERE topic_id IS NOT NULL AND n IS NOT NULL GROUP BY 1")
def completed_topics(spark, sf_dir):
    """Finished problems by topic, from the stored documents."""
    done = readers.completed_by_topic(stored_documents(spark, sf_dir))
    return done.select("topic_id", F.array_join(F.sort_array(F.col("problems").cast("array<string>")), ",").alias("problems"))


@query(f"WITH {LATEST_SQL} SELECT problem_key, grader_id, run_index, problem_quality, solution_completeness, solution_quality, test_case_quality, problem_quality_comment, (problem_quality IS NULL)::int + (solution_quality IS NULL)::int + (problem_quality_comment IS NULL)::int AS dropped FROM latest")
def serialised_grades(spark, sf_dir):
    """Grades written as JSON without their null fields, and read back."""
    fields = ["run_index", "problem_quality", "solution_completeness", "solution_quality", "test_case_quality", "problem_quality_comment"]
    rows = latest_of(spark, sf_dir).select("problem_key", "grader_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("text"))
    back = F.from_json("text", "run_index int, problem_quality int, solution_completeness int, solution_quality int, test_case_quality int, problem_quality_comment string")
    dropped = sum((F.when(F.get_json_object("text", f"$.{f}").isNull(), 1).otherwise(0) for f in ("problem_quality", "solution_quality", "problem_quality_comment")), F.lit(0))
    return rows.select("problem_key", "grader_id", back.alias("g"), dropped.cast("int").alias("dropped")).select("problem_key", "grader_id", "g.*", "dropped")


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN 2 END AS n, CASE WHEN event_id % 3 <> 0 THEN '{\"a\": ' || user_id || ', \"b\": 1}' END AS first_inputs FROM events")
def response_cases(spark, sf_dir):
    """Test cases read from answers around which a model talks; none where a case lacks an argument."""
    second = F.when(F.col("event_id") % 3 == 0, F.lit('{"a": 1}')).otherwise('{"b": "x", "a": null}')
    said = F.concat(F.lit('Here you are:\n```json\n{"test_cases": [{"inputs": {"a": '), F.col("user_id").cast("string"), F.lit(', "b": 1, "z": "}"}}, {"inputs": '), second, F.lit("}]}\n``` Good luck!"))
    found = cases.response_cases(table(spark, sf_dir, "events").select("event_id", said.alias("said")), "event_id", "said", ["a", "b"])
    return found.select("event_id", F.when(F.col("cases").isNotNull(), F.size("cases")).alias("n"), F.col("cases")[0]["inputs"].alias("first_inputs"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '[' || printf('%.6f', l_extendedprice * l_discount) || ', ' || printf('%.6f', l_tax / 7) || ']' AS shown FROM lineitem")
def formatted_outputs(spark, sf_dir):
    """Lists of numbers with the decimals that the tolerance leaves."""

    @F.pandas_udf("string")
    def shown(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([rounded([x, y]) for x, y in zip(a, b)])

    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shown(F.col("l_extendedprice") * F.col("l_discount"), F.col("l_tax") / 7).alias("shown"))


@query(f"WITH {NESTED_SQL} SELECT record_id, regexp_extract(details->>'$.Code', 'def\\s+(\\w+)', 1) AS name, regexp_extract_all(regexp_extract(details->>'$.Code', 'def\\s+\\w+\\(([^)]*)\\)', 1), '(\\w+)\\s*:', 1) AS args FROM top WHERE json_type(json_extract(details, '$.Code')) = 'VARCHAR' AND regexp_matches(details->>'$.Code', 'def\\s+\\w+')")
def function_heads(spark, sf_dir):
    """Name and arguments of every record's function, from its syntax tree."""

    @F.pandas_udf("name string, args array<string>")
    def head(codes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"name": [C.function_name(c) for c in codes], "args": [C.arguments(c) for c in codes]})

    code = F.get_json_object(T.repaired_text("record_json"), "$.problem_details.Code")
    rows = table(spark, sf_dir, "problem_records").select("record_id", code.alias("code")).where("code is not null")
    return rows.select("record_id", head("code").alias("h")).select("record_id", "h.*").where("name is not null")


# --- stages ---------------------------------------------------------------------------------


def stub_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "topics").select(F.col("topic_entry_id").alias("id"), "topic", "description", F.col("difficulty_level").alias("level"), "level_ord", "topic_ord")


@query(f"SELECT 'solver_failed' AS status, 0::bigint AS n WHERE false UNION ALL SELECT 'ok', {TOTAL}::bigint")
def pipeline_stub(spark, sf_dir):
    """All stages with the offline provider, whose functions all agree: what passes the grades is solved."""
    out = pipeline.run(stub_topics(spark, sf_dir), pipeline.Config(num_problems=TOTAL, level_split=LEVELS, max_k=1))
    return out["problems"].groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH h AS (SELECT *, md5(coalesce(arxiv_id, '') || ':' || coalesce(problem, '')) AS pair_hash FROM matched_pairs WHERE regexp_matches(problem, '[^{SPACE}]') AND regexp_matches(solution, '[^{SPACE}]')),
  once AS (SELECT *, row_number() OVER (PARTITION BY pair_hash ORDER BY arxiv_id NULLS FIRST, seed_type NULLS FIRST, pair_id) AS k FROM h WHERE pair_hash NOT IN (SELECT seed_pair_hash FROM problem_metadata WHERE seed_pair_hash IS NOT NULL))
  SELECT 'p' || row_number() OVER (ORDER BY arxiv_id NULLS FIRST, seed_type NULLS FIRST, pair_id) AS problem_id, pair_hash, seed_type, true AS stated FROM once WHERE k = 1""")
def adapted_stub(spark, sf_dir):
    """Problems made from all seed pairs that no document carries, as documents."""
    pairs = table(spark, sf_dir, "matched_pairs").select("arxiv_id", "seed_type", F.col("pair_id").alias("pos"), "problem", "solution", T.pair_hash(F.col("arxiv_id"), F.col("problem")).alias("pair_hash"))
    done = table(spark, sf_dir, "problem_metadata").where("seed_pair_hash is not null").select(F.col("seed_pair_hash").alias("pair_hash"))
    config = pipeline.Config(num_problems=1_000_000_000)
    docs = pipeline.as_documents(pipeline.generate_adapted(pairs, done, config), config, F.lit("2026-01-01"))
    meta = lambda k: F.try_element_at("problem_metadata", F.lit(k))
    return docs.select("problem_id", meta("Seed Pair Hash").alias("pair_hash"), F.col("original_seed.seed_type").alias("seed_type"), F.col("problem_details.Problem Statement").isNotNull().alias("stated"))


@query(f"WITH {COUNTS_SQL}, r AS (SELECT difficulty_level AS level, topic_entry_id, row_number() OVER (PARTITION BY difficulty_level ORDER BY topic_ord) - 1 AS slot, count(*) OVER (PARTITION BY difficulty_level) AS size FROM topics) SELECT topic_entry_id AS topic_id, count(*) AS problems FROM (SELECT level, unnest(range(0, n)) AS turn FROM counts) t JOIN r ON t.level = r.level AND turn % size = slot GROUP BY 1")
def generation_in_turns(spark, sf_dir):
    """Problems of one run that see each other within their topic: as many as planned, all different in a topic."""
    made = pipeline.generate_in_turns(stub_topics(spark, sf_dir), pipeline.Config(num_problems=TOTAL, level_split=LEVELS))
    return made.groupBy("topic_id").agg(F.count(F.lit(1)).alias("problems"))


@query()
def repair_stub(spark, sf_dir):
    """Every record's function run on cases by rule; where it fails the offline provider corrects it."""
    return cases.repair(record_cases(spark, sf_dir), Stub(), "stub", "record_id").select("record_id", "repairs", "error", F.size("results").alias("ran"))


@query()
def updated_outputs(spark, sf_dir):
    """Outputs of every record's cases as its function gives them now."""
    rows = record_cases(spark, sf_dir)
    typed = F.transform("cases", lambda c: F.struct(c["case_id"].alias("case_id"), c["inputs"].alias("inputs"), F.lit(None).cast("string").alias("output"), F.lit(None).cast("string").alias("output_type")))
    return cases.updated_outputs(rows.withColumn("cases", typed), "record_id", "code", "cases").select("record_id", "error", F.size(F.filter("cases", lambda c: c["output"].isNotNull())).alias("with_output"))


@query()
def evaluate_stub(spark, sf_dir):
    """Attempts that a solver still owes are made and graded; metrics per model over old and new ones."""
    problems = record_cases(spark, sf_dir).select(F.col("problem_key").cast("string").alias("problem_id"), F.lit("").alias("statement"), "code", "cases").dropDuplicates(["problem_id"]).where("problem_id is not null")
    old = verdict_facts(spark, sf_dir).where("verified is not null").select(F.col("problem_key").cast("string").alias("problem_id"), "model", F.col("attempt_ord").alias("attempt_no"), "verified")
    return pipeline.evaluate(problems, old, pipeline.Config(solver="stub", max_k=2))[1]


@query("SELECT problem_key, problem_description IS NOT NULL AS asked, true AS answered FROM problem_metadata")
def batch_calls(spark, sf_dir):
    """Calls in batches, answers in the order of the prompts."""
    rows = table(spark, sf_dir, "problem_metadata").select("problem_key", F.col("problem_description").alias("prompt"), F.lit("m").alias("model"))
    return call_batches(rows, Stub(), "prompt", "model").select("problem_key", F.col("prompt").isNotNull().alias("asked"), F.coalesce(F.col("response").startswith("\\section"), F.lit(False)).alias("answered"))
