import random

from pyspark.sql import functions as F

from sievework.llm import consensus
from sievework.llm.graph import components

SCHEMA = "grade_row_id bigint, problem_key bigint, grader_id string, run_index int, graded_at string, problem_quality int, problem_quality_comment string, solution_completeness int, solution_quality int, test_case_quality int"


def test_consensus_beats_the_majority(spark):
    draw = random.Random(3)
    truth = {k: draw.random() < 0.7 for k in range(400)}
    right = {"good1": 0.95, "good2": 0.95, "good3": 0.93, "contrary1": 0.1, "contrary2": 0.1, "noise": 0.5}
    rows, n = [], 0
    for k, yes in truth.items():
        for g, p in right.items():
            said = yes if draw.random() < p else not yes
            n += 1
            rows.append((n, k, g, 0, "2025-01-01", 90 if said else 40, None, 50, 90 if said else 40, 50))
    rows += [(n + 1, 0, "good1", None, None, None, None, None, 120, None), (n + 2, None, "good1", 0, None, 90, None, 1, 1, 1), (n + 3, 1, None, 0, None, 90, None, 1, 1, 1)]
    decided, graders = consensus.consensus(spark.createDataFrame(rows, SCHEMA).withColumn("votes", F.lit(1)).withColumn("v", F.lit(2)))
    got = {r.problem_key: r.consensus == "pass" for r in decided.where("metric = 'problem_quality'").collect()}
    assert sum(got[k] == truth[k] for k in truth) / len(truth) > 0.96
    rated = {r.grader_id: r.reliability for r in graders.where("metric = 'problem_quality'").collect()}
    assert rated["good1"] > 0.8 and rated["contrary1"] < -0.6 and abs(rated["noise"]) < 0.25


def test_the_greatest_run_is_the_vote(spark):
    rows = [(1, 1, "a", 0, None, 90, None, None, 90, None), (2, 1, "a", 3, None, None, None, None, 10, None), (3, 1, "a", 3, None, None, None, None, 10, None), (4, 1, "b", None, None, 101, None, None, -1, None)]
    votes = {r.grader_id: (r.p, r.s) for r in consensus.votes(spark.createDataFrame(rows, SCHEMA)).select("grader_id", consensus.vote_of("problem_quality").alias("p"), consensus.vote_of("solution_quality").alias("s")).collect()}
    assert votes == {"a": (None, 0), "b": (None, None)}
    decided, _ = consensus.consensus(spark.createDataFrame(rows, SCHEMA))
    assert [(r.metric, r.n_votes, r.agreement) for r in decided.collect()] == [("solution_quality", 1, None)]
    none, graders = consensus.consensus(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and graders.count() == 0


def test_components_of_a_path_a_hub_and_nulls(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(None, 3), (7, 7), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def graded(draw, n, right, per_item):
    """Rows of grades, with features that lean to the truth: problems of long descriptions are mostly good."""
    rows, metadata, truth, k = [], [], {}, 0
    for item in range(n):
        long = draw.random() < 0.5
        truth[item] = draw.random() < (0.9 if long else 0.1)
        metadata.append((item, "word " * (180 if long else 20)))
        for g in draw.sample(sorted(right), per_item):
            said = truth[item] if draw.random() < right[g] else not truth[item]
            k += 1
            rows.append((k, item, g, 0, "2025-01-01", 90 if said else 40, None, None, 90 if said else 40, None))
    return rows, metadata, truth


def test_features_of_the_item_help_where_votes_are_few(spark):
    rows, metadata, truth = graded(random.Random(4), 600, {"a": 0.7, "b": 0.65, "c": 0.6, "d": 0.75}, 2)
    grades = spark.createDataFrame(rows, SCHEMA)
    features = consensus.item_features(spark.createDataFrame(metadata + [(None, "x"), (10**6, None)], "problem_key bigint, problem_description string"))
    right = []
    for more in (None, features):
        got = {r.problem_key: r.consensus == "pass" for r in consensus.consensus(grades, more)[0].where("metric = 'problem_quality'").collect()}
        right.append(sum(got[k] == truth[k] for k in truth) / len(truth))
    assert right[1] > right[0] + 0.03


def test_each_round_raises_the_penalised_likelihood(spark):
    rows, _, _ = graded(random.Random(6), 300, {"a": 0.9, "b": 0.8, "c": 0.3, "d": 0.6}, 3)
    ready = consensus.items(consensus.votes(spark.createDataFrame(rows, SCHEMA)))
    model = consensus.fit(ready, ["a", "b", "c", "d"])
    assert len(model.objective) >= 3 and all(b >= a - 1e-6 * abs(a) for a, b in zip(model.objective[1:], model.objective[2:])) and model.objective[-1] > model.objective[0]


def test_gradings_inside_documents(spark):
    import json

    doc = lambda score: json.dumps({"quality_gradings": {"g": [{"index": 0, "problem_quality": 10}, {"index": 1, "problem_quality": score}], "h": {"index": 0, "problem_quality": "85"}}})
    records = spark.createDataFrame([(1, 7, doc(90)), (2, 7, doc(90)), (3, 8, None), (4, None, doc(20))], "record_id bigint, problem_key bigint, record_json string")
    got = consensus.consensus(consensus.from_records(records))[0].collect()
    assert [(r.problem_key, r.metric, r.consensus, r.n_votes) for r in got] == [(7, "problem_quality", "pass", 1)]
