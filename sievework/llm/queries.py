"""Queries of the problems on texts and labels, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, consensus, markup, mixing, neardup, pairs, pii, repetition, truncation
from sievework.queries import NESTED_SQL
from sievework.session import table

Query = Callable[[SparkSession, str], DataFrame]


def markup_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.fields_of([
        ("matched_pairs", table(spark, sf_dir, "matched_pairs"), "pair_id", ["problem", "solution"]),
        ("model_solutions", table(spark, sf_dir, "model_solutions"), "attempt_id", ["detailed_solution"]),
    ])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = markup_values(spark, sf_dir)
    return markup.found(values, markup.model_for(values))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = markup_values(spark, sf_dir)
    return markup.cleaned(values, markup.model_for(values)).select("table_name", "row_id", "field_name", "marked", F.array_join("kinds", ",").alias("kinds"), "clean_text")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.judge(table(spark, sf_dir, "matched_pairs"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).where("defect is not null").select("pair_id", "defect")


def p3_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir)


def repetition_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.ledger(table(spark, sf_dir, "model_solutions"), "attempt_id", "detailed_solution")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.apply_policy(repetition_ledger(spark, sf_dir), "v1").select("attempt_id")


def p4_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_ledger(spark, sf_dir)


def p4_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.ablation(repetition_ledger(spark, sf_dir))


def p4_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of the policy over one stored ledger."""
    return repetition.policies(repetition.stored(repetition_ledger(spark, sf_dir)))


def p4_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text and the share of them in runs of eight that occurred before."""
    return repetition_ledger(spark, sf_dir).select("attempt_id", "n_words", F.round("word_run_8", 9).alias("share"))


def truncation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.score(table(spark, sf_dir, "model_solutions"), "attempt_id", "detailed_solution", "model")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_scores(spark, sf_dir).where("cut").select("attempt_id")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(truncation_scores(spark, sf_dir), "model")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided, _ = consensus.consensus(table(spark, sf_dir, "quality_grades"))
    return decided.where("consensus = 'fail'").select("problem_key", "metric")


def p6_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.consensus(table(spark, sf_dir, "quality_grades"))[0]


def p6_graders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.consensus(table(spark, sf_dir, "quality_grades"))[1]


def p6_assisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus with features of the problems themselves in the classifier."""
    return consensus.consensus(table(spark, sf_dir, "quality_grades"), consensus.item_features(table(spark, sf_dir, "problem_metadata")))[0]


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus from the gradings inside problem documents."""
    return consensus.consensus(consensus.from_records(table(spark, sf_dir, "problem_records")))[0]


def p6_record_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = consensus.votes(consensus.from_records(table(spark, sf_dir, "problem_records")))
    return voted.select("problem_key", "grader_id", *(consensus.vote_of(m).cast("bigint").alias(m) for m in consensus.METRICS))


def p6_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = consensus.votes(table(spark, sf_dir, "quality_grades"))
    return voted.select("problem_key", "grader_id", *(consensus.vote_of(m).cast("bigint").alias(m) for m in consensus.METRICS))


def near_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.default_records(spark, lambda name: table(spark, sf_dir, name))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.found_pairs(near_records(spark, sf_dir))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(near_records(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.items_of(table(spark, sf_dir, "documents")).select("doc_id", "kind", "start_pos")


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_clean, p3_found, p3_scores, p4_found, p4_shares, p4_ablation, p4_policies, p4_runs, p5_found, p5_rates, p6_found, p6_consensus, p6_graders, p6_assisted, p6_records, p6_record_votes, p6_votes,
        p7_found, p7_groups, p8_ids, p9_mix, p9_selection, p10_found, p10_redacted,
    )
}

#: Sets of words of texts with eight words or more, classes of equal sets, and links between classes by counts of common words.
NEAR_SQL = r"""
        records AS (
          SELECT 'problem_metadata' AS t, problem_key AS id, regexp_extract_all(lower(problem_description), '[\pL\pN]+') AS w FROM problem_metadata WHERE problem_description IS NOT NULL AND problem_key IS NOT NULL
          UNION ALL SELECT 'matched_pairs', pair_id, regexp_extract_all(lower(problem), '[\pL\pN]+') FROM matched_pairs WHERE problem IS NOT NULL AND pair_id IS NOT NULL),
        sets AS (SELECT t, id, list_sort(list_distinct(w)) AS s FROM records WHERE len(w) >= 8),
        classes AS (SELECT t, min(id) AS rep, s, len(s) AS n FROM sets GROUP BY t, s),
        members AS (SELECT t, id, rep FROM sets JOIN classes USING (t, s)),
        words AS (SELECT t, rep, n, unnest(s) AS word FROM classes),
        links AS (
          SELECT a.t, a.rep AS a, b.rep AS b FROM words a JOIN words b ON a.t = b.t AND a.word = b.word AND a.rep < b.rep
          GROUP BY a.t, a.rep, b.rep, a.n, b.n HAVING count(*) * 10 >= 7 * (a.n + b.n - count(*)))"""

ORACLES: dict[str, str] = {
    "p7_found": f"""
        WITH {NEAR_SQL}
        SELECT x.t AS table_name, least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b FROM links JOIN members x ON x.t = links.t AND x.rep = a JOIN members y ON y.t = links.t AND y.rep = b
        UNION ALL SELECT x.t, x.id, y.id FROM members x JOIN members y ON x.t = y.t AND x.rep = y.rep AND x.id < y.id""",
    "p7_groups": f"""
        WITH RECURSIVE {NEAR_SQL},
        ends AS (SELECT t, a AS x, b AS y FROM links UNION ALL SELECT t, b, a FROM links),
        reach AS (SELECT t, x, y FROM ends UNION SELECT r.t, r.x, e.y FROM reach r JOIN ends e ON e.t = r.t AND e.x = r.y),
        grouped AS (SELECT t, x, least(x, min(y)) AS g FROM reach GROUP BY t, x),
        linked AS (SELECT t, x, count(*) AS n FROM ends GROUP BY t, x)
        SELECT m.t AS table_name, m.id, m.rep AS class_id, coalesce(g, m.rep) AS group_id, coalesce(n, 0) AS links
        FROM members m LEFT JOIN grouped ON grouped.t = m.t AND grouped.x = m.rep LEFT JOIN linked ON linked.t = m.t AND linked.x = m.rep""",
    "p4_runs": r"""
        WITH words AS (SELECT attempt_id, regexp_extract_all(lower(detailed_solution), '\pL+') AS w FROM model_solutions),
        starts AS (SELECT attempt_id, unnest(range(1, len(w) - 6)) AS i, w FROM words WHERE len(w) >= 8),
        runs AS (SELECT attempt_id, i, array_to_string(w[i:i+7], ' ') AS g FROM starts),
        again AS (SELECT attempt_id, i FROM (SELECT attempt_id, i, row_number() OVER (PARTITION BY attempt_id, g ORDER BY i) AS k FROM runs) WHERE k > 1),
        covered AS (SELECT attempt_id, count(DISTINCT at_word) AS c FROM (SELECT attempt_id, unnest(range(i, i + 8)) AS at_word FROM again) GROUP BY 1)
        SELECT attempt_id, coalesce(len(w), 0) AS n_words, round(coalesce(c, 0)::double / greatest(coalesce(len(w), 0), 1), 9) AS share FROM words LEFT JOIN covered USING (attempt_id)""",
    # runs of eight words that began earlier in the same text, over all texts
    "p4_found": r"""
        WITH words AS (
          SELECT attempt_id, regexp_extract_all(lower(detailed_solution), '\pL+') AS w
          FROM model_solutions WHERE detailed_solution IS NOT NULL),
        starts AS (
          SELECT attempt_id, len(w) AS n, unnest(range(1, len(w) - 6)) AS i, w FROM words WHERE len(w) >= 8),
        runs AS (SELECT attempt_id, n, i, array_to_string(w[i:i+7], ' ') AS g FROM starts),
        again AS (
          SELECT attempt_id, n, i FROM (
            SELECT attempt_id, n, i, row_number() OVER (PARTITION BY attempt_id, g ORDER BY i) AS k FROM runs) WHERE k > 1),
        covered AS (SELECT DISTINCT attempt_id, n, unnest(range(i, i + 8)) AS at FROM again)
        SELECT attempt_id FROM covered GROUP BY attempt_id, n HAVING count(*) * 10 >= 3 * n""",
    "p6_votes": """
        WITH last AS (
          SELECT *, row_number() OVER (PARTITION BY problem_key, grader_id
            ORDER BY coalesce(run_index, -1) DESC, graded_at DESC NULLS LAST, grade_row_id DESC) AS k
          FROM quality_grades WHERE problem_key IS NOT NULL AND grader_id IS NOT NULL)
        SELECT problem_key, grader_id,
          CASE WHEN problem_quality BETWEEN 0 AND 100 THEN (problem_quality >= 80)::bigint END AS problem_quality,
          CASE WHEN solution_quality BETWEEN 0 AND 100 THEN (solution_quality >= 80)::bigint END AS solution_quality
        FROM last WHERE k = 1""",
    "p6_record_votes": f"""
        WITH {NESTED_SQL},
        graded AS (
          SELECT problem_key, k AS grader_id, record_id, pos, CASE WHEN json_type(json_extract(e, '$.index')) IN ('BIGINT', 'UBIGINT') THEN (e->>'$.index')::bigint END AS i, e->>'$.timestamp' AS ts,
            CASE WHEN json_type(json_extract(e, '$.problem_quality')) IN ('BIGINT', 'UBIGINT') THEN (e->>'$.problem_quality')::bigint END AS p, CASE WHEN json_type(json_extract(e, '$.solution_quality')) IN ('BIGINT', 'UBIGINT') THEN (e->>'$.solution_quality')::bigint END AS s
          FROM gradings JOIN problem_records USING (record_id) WHERE problem_key IS NOT NULL),
        last AS (SELECT *, row_number() OVER (PARTITION BY problem_key, grader_id ORDER BY coalesce(i, -1) DESC, coalesce(ts, '') DESC) AS n FROM graded)
        SELECT problem_key, grader_id, CASE WHEN p BETWEEN 0 AND 100 THEN (p >= 80)::bigint END AS problem_quality, CASE WHEN s BETWEEN 0 AND 100 THEN (s >= 80)::bigint END AS solution_quality FROM last WHERE n = 1""",
}
