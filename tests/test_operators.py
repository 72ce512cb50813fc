import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.functions import code as C
from sievework.functions import sandbox
from sievework.functions import text as T
from sievework.operators import allocate, compare, grades, merge, predicates, verdicts
from sievework.plans import cases, pipeline, report
from sievework.sources import readers, sinks
from sievework.streaming import resume

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_normalise_verdicts(spark):
    raw = ['{"verified": 1}', '[{"verified": 0}, {"verified": null}]', "{}", "", None, "junk", "[]", " { } "]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "k int, r string")
    got = {(r.k, r.verdict_ord): r.verified for r in verdicts.facts(df, "r", ["k"]).collect()}
    assert got == {(0, 0): 1, (1, 0): 0, (1, 1): None}


def test_pass_at_k_hand_made(spark):
    df = spark.createDataFrame([("m", 1, 1, 0), ("m", 1, 2, 1), ("m", 1, 3, 0), ("m", 2, 1, None)], "model string, problem_key int, attempt_ord int, verified int")
    assert [(r.k, r.passed, r.problems) for r in verdicts.pass_at_k(df, 3).orderBy("k").collect()] == [(1, 0, 2), (2, 1, 2), (3, 1, 2)]
    s = verdicts.solver_summary(df, 3).collect()[0]
    assert (s.passed, s.failed, s.attempts_used, s.attempts_saved) == (1, 1, 3, 1)


def test_two_rules_of_the_latest_grade(spark):
    df = spark.createDataFrame([(1, "a", 5, 10, 1), (1, "a", 2, 20, 2), (1, "b", 9, 30, 3)], "p int, m string, run_index int, score int, grade_row_id int")
    assert {(r.m, r.score) for r in grades.latest(df, ["p", "m"]).collect()} == {("a", 10), ("b", 30)}
    r = grades.first_model_last_grade(df, "p", "m", F.col("grade_row_id"), ["grade_row_id"]).collect()[0]
    assert (r.m, r.score) == ("a", 20)


def test_running_context_and_parts_of_a_hot_problem(spark):
    df = spark.createDataFrame([(1, "t", "a"), (2, "t", " "), (3, "t", None), (4, "t", "b"), (5, "u", "c")], "k int, topic string, d string")
    full = df.select("k", allocate.previous(df, "topic", ["k"], "d").alias("p")).orderBy("k").collect()
    assert [r.p for r in full] == [[], ["a"], ["a"], ["a"], []]
    short = allocate.latest_before(df, "topic", ["k"], "d").orderBy("k").collect()
    assert [(r.earlier, r.last_earlier) for r in short] == [(0, None), (1, "a"), (1, "a"), (1, "a"), (0, None)]
    rows = spark.range(100).selectExpr("id as grade_row_id", "1 as p", "'m' as g", "cast(id as int) as run_index", *(f"80 as {m}" for m in grades.METRICS))
    docs = grades.to_documents(rows, "p", "g", most=30)
    assert docs.count() == 4 and grades.from_documents(docs, "p", "g").select("grade_row_id").distinct().count() == 100


def test_passes_threshold_and_nulls(spark):
    df = spark.createDataFrame([(80, 80), (79, 90), (None, 90)], "a int, b int")
    assert [r[0] for r in df.select(grades.passes(("a", "b"), 0.8)).collect()] == [True, False, False]
    assert int(0.29 * 100) == 28


@QUICK
@given(total=st.integers(0, 40), ratios=st.lists(st.floats(0, 5), min_size=1, max_size=5))
def test_level_counts_add_up(spark, total, ratios):
    df = spark.createDataFrame([(f"l{k}", k, float(r)) for k, r in enumerate(ratios)], "level string, level_ord int, ratio double")
    got = {r.level: r.n for r in allocate.level_counts(df, total).collect()}
    assert sum(got.values()) == total
    weight = [r / sum(ratios) if sum(ratios) > 0 else 1 / len(ratios) for r in ratios]
    assert all(abs(got[f"l{k}"] - total * w) < 1 + 1e-9 for k, w in enumerate(weight))


def test_distribution_of_five_problems(spark):
    levels = spark.createDataFrame([(x, k, 0.25) for k, x in enumerate(("UG", "GR", "AG", "PG"))], "level string, level_ord int, ratio double")
    topics = spark.createDataFrame([(x, f"{x}-{n}", n) for x in ("UG", "GR", "AG", "PG") for n in (1, 2, 3)], "level string, id string, topic_ord int")
    got = allocate.distribute(allocate.level_counts(levels, 5), topics, "level", "level_ord", "id", "topic_ord")
    assert {r.id: r.problem_no for r in got.collect()} == {"UG-1": 1, "UG-2": 2, "GR-1": 3, "AG-1": 4, "PG-1": 5}


@pytest.mark.parametrize("n, ratio, val, sizes", [(10, 0.8, None, (8, 2)), (10, 0.8, 20, (0, 10)), (0, 0.8, None, (0, 0)), (7, 0.5, 3, (4, 3))])
def test_split_sizes_are_exact(spark, n, ratio, val, sizes):
    got = [r.part for r in allocate.split(spark.range(n), "id", ratio, val).collect()]
    assert (got.count("train"), got.count("val")) == sizes


def test_numbering_has_no_gaps_and_no_ties(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as g", "cast(null as string) as item_no2")
    got = [r.k for r in allocate.numbered(df, ["g", "id"], "k").orderBy("g", "id").collect()]
    assert got == list(range(1000))


def test_merging_twice_changes_nothing(spark):
    schema = "p int, m string, t string, s string, n int"
    base = spark.createDataFrame([(1, "a", "t1", "x", 1), (1, "a", "t1", "x", 2), (1, "a", None, "y", 3)], schema)
    new = spark.createDataFrame([(1, "a", "t1", "x", 9), (1, "b", "t1", "x", 8)], schema)
    once = merge.merge_attempts(base, new, ["p", "m"], "t", "s", "n")
    got = sorted((r.m, r.n, r.merged_from) for r in once.collect())
    assert got == [("a", 2, "base"), ("a", 3, "base"), ("a", 9, "both"), ("b", 8, "incoming")]
    again = merge.merge_attempts(once.drop("merged_from"), new, ["p", "m"], "t", "s", "n")
    assert again.where("merged_from = 'incoming'").count() == 0


def test_comparing(spark):
    assert compare.alike(1, 1 + 1e-6) and not compare.alike(1, 1 + 1.1e-6) and compare.alike(True, 1)
    assert compare.alike("1+2i", {"re": 1, "im": 2}) and not compare.alike(float("nan"), float("nan")) and compare.alike((1, [2]), [1, (2,)])
    assert compare.alike(None, None) and not compare.alike(None, None, compat=True) and not compare.alike([1], [1, 2]) and compare.alike({"a": [1]}, {"a": [1.0]})
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (float("nan"), float("nan"))], "a double, b double")
    assert [r[0] for r in df.select(compare.close(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    js = spark.createDataFrame([("[1, 2]", "[1, 2.0000001]"), ("{", "{"), (None, None)], "a string, b string")
    assert [r[0] for r in js.select(compare.alike_udf()("a", "b")).collect()] == [True, True, True]


def test_sections_and_code(spark):
    rows = ["\\section{Problem Statement}\nold\n\\section{Code}\n```python\nx = 1\n```\n\\section{Problem Statement}\nnew", "no sections", None, "\\begin{python}\na\n\\end{python}\n```python\nb\n```"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select(T.sections(F.col("t")).alias("s"), T.last_code(F.col("t")).alias("c")).collect()
    assert got[0].s["Problem Statement"] == "new" and got[0].s["Code"] == "x = 1" and got[1].s == {"Problem Statement": "no sections"} and got[2].s is None
    assert [r.c.strip() if r.c else None for r in got] == ["x = 1", None, None, "b"]


def test_first_object_knows_strings():
    assert T.first_object('x {"a": "}"} y') == '{"a": "}"}' and T.first_object("{ {") is None and T.first_object(None) is None
    assert T.repaired('{"a": 1}}}') == '{"a": 1}' and T.repaired('{"a"') is None


def test_code_functions():
    source = "def f(x, mode):\n    d = {'a': 1, 'b': 2}\n    if mode == 'c':\n        return 1 / x\n    return d[mode] + math.sqrt(x)\n"
    assert C.function_name(source) == "f" and C.function_name("(") is None
    assert C.unsafe_operations(source, ["x", "mode"]) == {"x": ["division_by_zero", "domain_error"], "mode": []}
    assert sorted(C.string_keys(source, "mode")) == ["a", "b", "c"]
    assert C.coerced("yes", "bool") is True and C.coerced("x", "int") == "x" and C.coerced("1+2i", "complex") == 1 + 2j
    assert json.dumps(C.jsonable({"a": (1, complex(1, 2), float("inf"))})) == '{"a": [1, "(1+2j)", null]}'


def test_sandbox_limits():
    assert sandbox.run("def f(x):\n    return x + 1", [{"x": 1}])["results"] == [{"output": 2, "type": "int"}]
    assert sandbox.run("def f(x):\n    while True: pass", [{"x": 1}], seconds=1)["error"] == "timed out"
    assert "ImportError" in sandbox.run("import os\ndef f(x):\n    return os.getcwd()", [{"x": 1}])["error"]
    assert sandbox.run("def f(x):\n    return float('inf')", [{"x": 1}])["error"].startswith("ValueError")
    assert sandbox.run("x = 1", [{"x": 1}])["error"] == "no function found" and sandbox.run(None, [])["error"] == "no code found"


def test_cases_are_alike_and_safe():
    code = "def f(x: float, k: int) -> float:\n    return math.log(x) / k\n"
    made = cases.inputs_for(code, "p1")
    assert made == cases.inputs_for(code, "p1") and len(made) == 5
    for case in made:
        inputs = json.loads(case["inputs"])
        assert inputs["x"] > 0 and abs(inputs["k"]) >= 1e-9
    assert cases.from_response('ok {"test_cases": [{"inputs": {"x": 1, "z": 2}}]}', ["x"]) == [{"case_id": 1, "inputs": '{"x": 1}'}]
    assert cases.from_response('{"test_cases": [{"inputs": {}}]}', ["x"]) is None


def test_routing(spark):
    names = ["gpt-4", "gpt4", "deepseek-x", "deepseek-ai/DeepSeek-R1-Distill-a", "openai/gpt-oss-20b", None]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    assert [r[0] for r in df.select(predicates.is_remote(F.col("m"))).collect()] == [True, False, True, False, True, False]
    ok = predicates.with_status(spark.createDataFrame([(True,), (None,)], "k boolean"), F.col("k"), "qc_failed")
    assert [r.status for r in ok.collect()] == ["ok", "qc_failed"]


def test_documents_from_files(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)

    good = {"problem_id": "p1", "problem_metadata": {"Topic Entry ID": "A-1", "Seed Pair Hash": "h"}, "quality_gradings": {"m": [{"index": 0, "problem_quality": 90}]}, "model_solutions": [{"model": "x", "attempts": [{"detailed_solution": "s", "verifier_result": [{"verified": 1}]}]}]}
    put("p1.json", json.dumps(good) + "}}")
    put("p2.json", "[1, 2]")
    put("p3.json", '{"problem_id": "p3"')
    put("quality_report.json", "[]")
    put("qc_failed/p10.json", json.dumps({"problem_id": "p10"}))
    flat = readers.documents(spark, str(tmp_path))
    assert [r.problem_id for r in flat.collect()] == ["p1"]
    deep = readers.documents(spark, str(tmp_path), recursive=True)
    assert {(r.problem_id, r.status_dir) for r in deep.collect()} == {("p1", None), ("p10", "qc_failed")}
    assert readers.greatest_index(deep).collect()[0][0] == 10
    assert readers.broken_documents(spark, str(tmp_path)).count() == 2
    assert verdicts.facts(readers.attempts(flat), "verifier_result", ["model"]).collect()[0].verified == 1
    assert readers.grades(flat).collect()[0].problem_quality == 90 and readers.processed_hashes(flat).collect()[0][0] == "h"
    assert [r.problems for r in readers.completed_by_topic(flat).collect()] == [[1]]
    sinks.write_documents(flat.withColumn("status", F.lit("ok")), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    sinks.export_files(flat, str(tmp_path / "files"))
    assert json.loads((tmp_path / "files" / "p1.json").read_text())["problem_id"] == "p1"


def test_topics_seeds_and_ledger(spark, tmp_path):
    (tmp_path / "topic_list.json").write_text(json.dumps({"UG": {"a": [{"id": "1", "topic": "t"}], "b": [{"id": "2", "topic": "u"}]}, "GR": {}}))
    assert [(r.level, r.topic_ord, r.id) for r in readers.topics(spark, str(tmp_path / "topic_list.json")).collect()] == [("UG", 0, "1"), ("UG", 1, "2")]
    (tmp_path / "seed1").mkdir()
    (tmp_path / "seed1" / "matched_pairs.yaml").write_text("problem: {type: a, content: P}\nsolution: S\n---\n---\nproblem: 3\n")
    got = readers.seed_pairs(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.arxiv_id, r.seed_type, r.problem, r.solution) for r in got] == [("seed1", "matched", "P", "S"), ("seed1", "matched", "", "")]
    (tmp_path / "assignment.json").write_text('{"t": ["1", 2, "x"]}')
    assert sorted(r.problem_no for r in readers.assignment(spark, str(tmp_path / "assignment.json")).collect()) == [1, 2]


def test_rewrite_swaps_a_table_that_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    merge.rewrite(spark, path, spark.read.parquet(path).where("id > 0"))
    assert spark.read.parquet(path).count() == 2 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_pipeline_with_the_stub(spark):
    topics = spark.createDataFrame([("UG", 0, "UG-1", 0, "T", None), ("GR", 1, "GR-1", 0, "U", "D")], "level string, level_ord int, id string, topic_ord int, topic string, description string")
    config = pipeline.Config(num_problems=3, qc_runs=2)
    assert pipeline.run(topics, pipeline.Config(num_problems=3, dry_run=True))["plan"].count() == 3
    got = pipeline.run(topics, config)
    assert got["problems"].count() == 3 and got["grades"].count() == 6
    assert {(r.passed, r.attempts_needed) for r in got["results"].collect()} == {(True, 1)}
    with pytest.raises(ValueError):
        pipeline.generation_plan(topics, pipeline.Config(level_split={"XX": 1.0}))


def test_report(spark):
    text = report.document({"A & B": spark.createDataFrame([("m_1", 0.5, None)], "model string, rate double, x int")})
    assert "A \\& B" in text and "m\\_1 & 0.500 & --" in text
    with pytest.raises(ValueError):
        report.table_of(spark.range(600), "t")
    rows = report.problem_sections(spark.createDataFrame([("T", "50% of $a_1$", None)], "t string, p string, s string"), F.col("t"), F.col("p"), F.col("s")).collect()
    assert "50\\% of $a_1$" in rows[0][0]


def test_streams(spark, sf, tmp_path):
    (tmp_path / "in").mkdir()
    spark.read.parquet(f"{sf}/model_solutions.parquet").write.mode("overwrite").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema.simpleString()[len("struct<"):-1]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(str(tmp_path / "in")).schema.fields)
    assert schema
    stream = resume.file_stream(spark, str(tmp_path / "in"), ddl)
    q = resume.each_batch(stream, lambda b: verdicts.verification_metrics(verdicts.facts(b, "verifier_result", ["model"])), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    counts = resume.verdict_counts(resume.file_stream(spark, str(tmp_path / "in"), ddl).withColumn("loaded_at", F.col("loaded_at").cast("timestamp")))
    q = counts.writeStream.format("memory").queryName("vc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(correct) from vc").collect()[0][0] > 0
