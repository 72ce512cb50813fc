"""Stages, prompts, repair, evaluation and the readers of files, on small hand-made tables."""

import json

import pytest
from pyspark.sql import functions as F

from sievework.functions import code as C
from sievework.functions import text as T
from sievework.operators import compare, grades, merge, predicates
from sievework.plans import cases, pipeline, prompts, providers, report
from sievework.sources import readers, sinks

GOOD = "def f(x: int) -> int:\n    return x + 1"


def Scripted():
    """A provider, pickled by value, that answers by what the prompt holds."""
    good = GOOD

    class Provider:
        def __call__(self, prompt, model, system=None):
            if prompt.startswith("Correct"):
                return f"```python\n{good}\n```"
            if prompt.startswith("Grade"):
                return "no idea" if "unclear" in prompt else json.dumps({"problem_quality": 90, "solution_completeness": 90, "solution_quality": 40 if "bad" in prompt else 90})
            return f"```python\n{good if 'right' in prompt else 'def f(x):' + chr(10) + '    return 0'}\n```"

        def batch(self, prompts, model):
            return [p.upper() for p in prompts][: 1 if model == "short" else None]

    return Provider()


def test_filters_stand_between_the_stages(spark):
    rows = [(f"p{k}", s, "s", "a", GOOD) for k, s in enumerate(["right one", "wrong one", "right but bad", "right but unclear"])]
    problems = spark.createDataFrame(rows, "problem_id string, statement string, solution string, answer string, code string")
    out = pipeline.finish(problems, pipeline.Config(provider=Scripted(), graders=("g",), max_k=1, tries=2))
    assert {r.problem_id: r.status for r in out["problems"].collect()} == {"p0": "ok", "p1": "solver_failed", "p2": "qc_failed", "p3": "qc_failed"}
    # only what passed the grades was solved
    assert {r.problem_id for r in out["results"].collect()} == {"p0", "p1"}
    assert pipeline.finish(problems.where("false"), pipeline.Config(provider=Scripted()))["problems"].count() == 0


def test_problems_of_one_run_see_each_other(spark):
    seen = []

    class Telling:
        def __call__(self, prompt, model, system=None):
            return "\\section{Problem Statement}\nAfter " + str(prompt.count("\\section") + prompt.count("After")) + " others"

    topics = spark.createDataFrame([("A", "t", None, "L", 0, 0), ("B", "u", "d", "L", 0, 1)], "id string, topic string, description string, level string, level_ord int, topic_ord int")
    made = pipeline.generate_in_turns(topics, pipeline.Config(num_problems=5, level_split={"L": 1.0}, provider=Telling())).collect()
    for topic, n in (("A", 3), ("B", 2)):
        seen = [r.statement for r in sorted((r for r in made if r.topic_id == topic), key=lambda r: r.problem_no)]
        assert seen == [f"After {k} others" for k in range(n)]


def test_adapted_problems_and_documents(spark):
    pairs = spark.createDataFrame([("x", "matched", 0, "P", "S", "h0"), ("x", "matched", 1, "P", "S", "h0"), ("x", "example", 0, "Q", " \n ", "h1"), ("y", "example", 0, "R", "S", "h2"), ("y", "matched", 0, "T", "S", "h3")], "arxiv_id string, seed_type string, pos int, problem string, solution string, pair_hash string")
    done = spark.createDataFrame([("h3",)], "pair_hash string")
    config = pipeline.Config(num_problems=5)
    plan = pipeline.generate_adapted(pairs, done, pipeline.Config(num_problems=1, dry_run=True)).collect()
    assert [(r.problem_no, r.pair_hash) for r in plan] == [(1, "h0")] and "Problem: P" in plan[0].prompt
    docs = pipeline.as_documents(pipeline.generate_adapted(pairs, done, config), config, F.lit("2026-01-02")).collect()
    assert {d.problem_metadata["Seed Pair Hash"] for d in docs} == {"h0", "h2"} and all(d.problem_details["Code"].startswith("\\begin{python}") and d.problem_metadata["Date Added"] == "2026-01-02" for d in docs)
    assert {d.original_seed.seed_data.problem for d in docs} == {"P", "R"}


def test_repair_keeps_what_runs_and_corrects_the_rest(spark):
    one = [(1, json.dumps({"x": "3"}))]
    rows = [("a", GOOD, one, None), ("b", "def f(x: int) -> int:\n    return y", one, None), ("c", GOOD, one, ["too few cases"]), ("d", None, one, None)]
    df = spark.createDataFrame(rows, "id string, code string, cases array<struct<case_id:int,inputs:string>>, reviews array<string>")
    got = {r.id: r for r in cases.repair(df, Scripted(), "m", "id", reviews_col="reviews").collect()}
    assert {k: r.repairs for k, r in got.items()} == {"a": 0, "b": 1, "c": 1, "d": 1} and all(r.error is None for r in got.values())
    # "3" was made an int by the argument's type
    assert json.loads(got["a"].results[0].output) == 4
    typed = df.select("id", "code", F.transform("cases", lambda c: F.struct(c["case_id"].alias("case_id"), c["inputs"].alias("inputs"), F.lit("old").alias("output"), F.lit("str").alias("output_type"))).alias("cases"))
    new = {r.id: (r.error is None, r.cases[0].output) for r in cases.updated_outputs(typed, "id", "code", "cases").collect()}
    assert new == {"a": (True, "4"), "b": (False, "old"), "c": (True, "4"), "d": (False, "old")}


def test_evaluation_tops_up_and_reports(spark, tmp_path):
    problems = spark.createDataFrame([("p1", "right", GOOD, [(1, '{"x": 1}')]), ("p2", "wrong", GOOD, [(1, '{"x": 1}')])], "problem_id string, statement string, code string, cases array<struct<case_id:int,inputs:string>>")
    old = spark.createDataFrame([("p1", "m", 1, 0), ("p2", "m", 1, 0), ("p2", "m", 2, 1)], "problem_id string, model string, attempt_no int, verified int")
    every, metrics = pipeline.evaluate(problems, old, pipeline.Config(solver="m", max_k=2, provider=Scripted()))
    assert {(r.problem_id, r.attempt_no): r.verified for r in every.collect()} == {("p1", 1): 0, ("p1", 2): 1, ("p2", 1): 0, ("p2", 2): 1}
    assert metrics.first().best_of_n == 1.0
    facts = every.select(F.col("problem_id").alias("problem_key"), "model", F.lit("3").alias("level"), F.col("attempt_no").alias("attempt_ord"), "verified")
    path = str(tmp_path / "r.tex")
    report.write_report(report.evaluation(facts, problems, 1, models=("m",)), report.problem_sections(problems, F.col("problem_id"), F.col("statement"), F.col("code")), path)
    text = open(path, encoding="utf-8").read()
    assert "Best of n by model" in text and spark.read.text(str(tmp_path / "r_problems")).where("value like '%section%'").count() >= 2


def test_calls_in_batches_and_keys(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a", "m"), (2, "b", "m"), (3, None, "short"), (4, "d", "short")], "id int, prompt string, model string")
    got = {r.id: (r.response, r.error) for r in providers.call_batches(df.coalesce(1), Scripted(), "prompt", "model").collect()}
    assert got[1] == ("A", None) and got[2] == ("B", None) and got[4][0] is None and "answers to 2" in got[4][1]
    monkeypatch.delenv("SIEVEWORK_KEY_CLAUDE", raising=False)
    (tmp_path / "keys").write_text("# keys\nSIEVEWORK_KEY_CLAUDE = abc\nOTHER=x\n".replace(" = ", "="))
    assert providers.key_for("claude-x", [str(tmp_path / "none"), str(tmp_path / "keys")]) == "abc" and providers.key_for("grok-1", [str(tmp_path / "keys")]) is None


def test_prompts_say_what_they_should(spark):
    one = spark.range(1)
    text = lambda c: one.select(c).first()[0]
    null = F.lit(None).cast("string")
    assert "SEED" not in text(prompts.grading(F.lit("p"), null, null, null, F.lit("none"), null)) and "output_seed_correspondence" in text(prompts.grading(F.lit("p"), null, null, null, F.lit("none"), F.lit("s")))
    assert "f(x: int)" in text(prompts.repair(F.lit(GOOD), null, F.array(F.lit("r1"), F.lit("r2")))) and "2. r2" in text(prompts.repair(F.lit(GOOD), null, F.array(F.lit("r1"), F.lit("r2"))))
    assert text(prompts.correspondence(F.lit("s" * 3000), F.lit("example"), F.lit("x"), F.lit("y"))).count("s" * 2000 + "...") == 1
    assert "f(x: int)" in text(prompts.test_cases(F.lit(GOOD))) and text(prompts.solving(F.lit("p"), null, null, F.lit(2))).endswith("Attempt 2")


def test_files_of_many_lines_are_whole_documents(spark, tmp_path):
    doc = {"problem_id": "p1", "problem_metadata": {"Topic Entry ID": "T"}, "quality_gradings": {"m": [], "n": [{"index": 5, "problem_quality": 1}, {"index": 2, "problem_quality": 2}]}, "quality": {"problem_quality": 9}, "x": float("nan")}
    (tmp_path / "qc_failed").mkdir()
    (tmp_path / "p1.json").write_text(json.dumps(doc, indent=2) + "\n}}")
    (tmp_path / "qc_failed" / "p2.json").write_text(json.dumps({"problem_id": "p2", "quality": {"problem_quality": 7}}, indent=2))
    (tmp_path / "p3.json").write_text('{"problem_id": "p3", ')
    docs = readers.documents(spark, str(tmp_path), recursive=True)
    last = grades.document_grade(F.col("quality_gradings"), F.col("quality"))
    assert {(r.problem_id, r.status_dir, r.g) for r in docs.select("problem_id", "status_dir", last["problem_quality"].alias("g")).collect()} == {("p1", None, 2), ("p2", "qc_failed", 7)}
    assert [r.file_path.rsplit("/", 1)[-1] for r in readers.broken_documents(spark, str(tmp_path)).collect()] == ["p3.json"]


def test_log_holds_each_key_once(spark, tmp_path):
    path = str(tmp_path / "log")
    for ids in ([1, 1, 2], [2, 3]):
        merge.append_log(spark.createDataFrame([(k,) for k in ids], "id int"), path, ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_older_sections_and_subsections(spark):
    raw = "### A) Problem\nGiven x.\n**B) Answer Requirements**\nA number.\nC) Solution\n```python\ncode\n```\n\\section{Odd}\nD) Answer\n7\nE) Code\n\\subsection{Task 1}\none\n\\subsection{Task 2}\ntwo"
    got = spark.range(1).select(T.sections(F.lit(raw)).alias("s")).select("s", T.first_subsection(F.try_element_at("s", F.lit("Code"))).alias("code")).first()
    assert got.s == {"Problem Statement": "Given x.", "Answer Requirements": "A number.", "Solution": "code", "Answer": "7", "Code": "\\subsection{Task 1}\none\n\\subsection{Task 2}\ntwo"} and got.code == "one"
    assert spark.range(1).select(T.sections(F.lit("plain"))).first()[0] == {"Problem Statement": "plain"}


def test_small_functions(spark):
    assert compare.scrubbed({"a": [float("nan"), "Inf", {"b": float("inf")}], "c": "info"}) == {"a": [None, None, {"b": None}], "c": "info"}
    assert C.documented_values('mode: One of {"A", "B"}. Other.', "mode") == ["A", "B"] and C.documented_values("Can be one of 'u', 'v'", "k") == ["u", "v"] and C.documented_values("k: a number", "k") is None
    assert C.argument_types("def f(a: Optional[int], b: np.ndarray, c, d: Tuple[float, float] = None): pass") == {"a": "int", "b": "ndarray", "d": "Tuple"}
    df = spark.createDataFrame([("a", "\n\t ", "s"), ("b", "p", "s"), ("c", None, "s")], "id string, problem string, solution string")
    assert [r.id for r in predicates.valid_pairs(df).collect()] == ["b"]
    sinks.write_text("x", "/tmp/sievework-test.txt")


@pytest.mark.parametrize("rows, want", [([("g", 50, 90, 90, 90)], []), ([("g", 90, 90, 90, 50)], []), ([("g", 90, 90, 90, 50), ("h", 90, None, 90, 90)], [1])])
def test_required_graders(spark, rows, want):
    df = spark.createDataFrame([(1, *r) for r in rows], "problem_key int, grader_id string, problem_quality int, solution_completeness int, solution_quality int, test_case_quality int")
    assert [r.problem_key for r in grades.only_failing(df, "problem_key", "grader_id", "test_case_quality", 80, required=("g", "h")).collect()] == want


def test_configuration_files(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("topic_name: t\nnum_problems: 7\nlevel_split: {A: 0.5, B: 0.5}\nmodel: m\ntask_config: {tasks_min: 1, tasks_max: 3, tasks_dependent: true}\nverbose: false\n")
    got = pipeline.configured(str(tmp_path / "c.yaml"), max_k=2)
    assert (got.topic_name, got.num_problems, got.level_split, got.generator, got.tasks, got.dependent, got.max_k, got.solver) == ("t", 7, {"A": 0.5, "B": 0.5}, "m", (1, 3), True, 2, "stub")
    assert open(sinks.copy_config(str(tmp_path / "c.yaml"), str(tmp_path / "set"))).read().startswith("topic_name")


def test_errors_of_files_with_their_lines(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"problem_id": "p1"}')
    (tmp_path / "p10.json").write_text('{"problem_id": "p10"}')
    (tmp_path / "p2.json").write_text('{\n "problem_id": "p2",\n "x": oops\n}\n')
    (row,) = readers.errors(spark, str(tmp_path)).collect()
    assert row.line == 3 and '"x": oops' in row.around and row.around.count("\n") == 4 and row.file_path.endswith("p2.json")
    assert [r.problem_id for r in readers.documents(spark, str(tmp_path), ordered=True).collect()] == ["p1", "p10"]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.documents(spark, str(tmp_path / "none"), required=True)


def test_seed_folders_and_limits(spark, tmp_path):
    for name, files in (("2301.1", ()), ("plain", ()), ("kept", ("matched_pairs.yaml", "example_pairs.yaml"))):
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f).write_text("---\n".join(f"problem: {{type: t, content: p{k}}}\nsolution: s\n" for k in range(3)) + "---\n")
    assert readers.seed_directories(spark, str(tmp_path)) == ["2301.1", "kept"]
    got = readers.seed_pairs(spark, str(tmp_path), examples=1, matched=2).collect()
    assert sorted((r.arxiv_id, r.seed_type, r.pos, r.problem) for r in got) == [("kept", "example", 0, "p0"), ("kept", "matched", 0, "p0"), ("kept", "matched", 1, "p1")]


def test_merged_save_scrubs_and_is_checked(spark, tmp_path):
    path = str(tmp_path / "docs")
    base = spark.createDataFrame([("p1", '{"a": NaN}', "x"), ("p2", '{"a": 2}', None)], "problem_id string, body string, note string")
    merge.save_merged(spark, path, base, "problem_id", ["body"])
    merge.save_merged(spark, path, spark.createDataFrame([("p2", None, "new"), ("p3", '{"a": "inf"}', "z")], base.schema), "problem_id", ["body"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("p1", '{"a": null}', "x"), ("p2", '{"a": 2}', "new"), ("p3", '{"a": null}', "z")}


def test_values_json_cannot_hold(spark):
    code = "def f(z: complex, v: np.ndarray, t: tuple, n: int) -> complex:\n    return z * sum(v) + t[0] * n if isinstance(t, tuple) else None"
    one = [(1, json.dumps({"z": {"re": 1, "im": 2}, "v": [1, 2], "t": [5], "n": "3"}))]
    df = spark.createDataFrame([("a", code, one)], "id string, code string, cases array<struct<case_id:int,inputs:string>>")
    row = cases.execute(df, "id", "code", "cases").first()
    assert row.error is None and json.loads(row.results[0].output) == {"re": 18.0, "im": 6.0}
    assert C.rehydrated(C.jsonable({"a": [1 + 2j, (3.0, None)], "b": "in"})) == {"a": [1 + 2j, [3.0, None]], "b": "in"} and C.rehydrated({"re": 1, "im": 0.5}) == 1 + 0.5j


def test_report_text_forms(spark):
    assert T.escaped("x² and y₁₂ → 5%") == "x$^{2}$ and y$_{12}$ $\\to$ 5\\%"
    one = spark.range(1)
    both = one.select(T.report_text(F.lit("<think>why</think> so")), T.report_text(F.lit("<think>why</think> so"), thoughts=True)).first()
    assert both[0] == "so" and both[1] == "why so"


def test_documents_due_for_their_seed_only(spark):
    rows = [("a", ("matched",), (None,)), ("b", ("matched",), (80,)), ("c", None, (None,)), ("d", ("matched",), None)]
    df = spark.createDataFrame(rows, "problem_id string, original_seed struct<seed_type:string>, quality struct<seed_correspondence:int>")
    assert sorted(r.problem_id for r in grades.seed_only_due(df).collect()) == ["a", "d"]
