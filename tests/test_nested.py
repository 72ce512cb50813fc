import json

from sievework.operators import nested


def rows(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "record_id bigint, record_json string").selectExpr("record_id", "record_json", "record_id as tag", "'x' as payload")
    return {tuple(r) for r in nested.found(df).collect()}


def test_shapes_and_positions(spark):
    doc = {
        "problem_details": {"test": {"test_cases": [None, {"inputs": {"a": 1, "b": None}}, '{"inputs": {"c": 2}}']}},
        "quality_gradings": {"m": {"index": 0}, "n": [None, {"index": 1}]},
        "model_solutions": [{"model": "x", "attempts": {"verifier_result": [{}, {"verified": 1, "test_cases": {"inputs": {}}}]}}, None, {"attempts": None}],
    }
    assert rows(spark, [json.dumps(doc) + '\n{"partial": tr']) == {
        (0, "test_cases", "", "1"), (0, "test_cases", "", "2"), (0, "case_inputs", "1", "a"), (0, "case_inputs", "1", "b"), (0, "case_inputs", "2", "c"),
        (0, "gradings", "m", "0"), (0, "gradings", "n", "1"), (0, "models", "", "0"), (0, "models", "", "2"), (0, "attempts", "0", "0"),
        (0, "verdicts", "0/0", "1"), (0, "verdict_cases", "0/0/1", "0"),
    }


def test_damaged_null_and_empty(spark):
    assert rows(spark, [None, "", "{", '{"model_solutions": [', "[1]", "17", '{"model_solutions": NaN}', "[" * 100_000]) == set()
    empty = spark.createDataFrame([], "record_id bigint, record_json string")
    assert nested.found(empty).collect() == []


def test_write_and_read_keep_links(spark, sf, tmp_path):
    records = spark.read.parquet(f"{sf}/problem_records.parquet")
    nested.write(records, str(tmp_path / "t"))
    emitted = nested.emit(records).groupBy("tag").count().collect()
    for tag, n in emitted:
        assert nested.read(spark, str(tmp_path / "t"), tag).count() == n
    models = {(r.record_id, r.child_key) for r in nested.read(spark, str(tmp_path / "t"), "models").collect()}
    attempts = nested.read(spark, str(tmp_path / "t"), "attempts").collect()
    assert attempts and all((a.record_id, a.parent_key) in models for a in attempts)
    plan = nested.read(spark, str(tmp_path / "t"), "models")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan


def test_nothing_of_an_element_is_lost(spark, tmp_path):
    doc = {
        "quality_gradings": {"m": [{"index": 0, "problem_quality": "80", "seed_correspondence": 5, "output_seed_correspondence_comment": "c", "extra": [1]}, 7, "plain"]},
        "model_solutions": ["text", {"model": 3, "attempts": []}],
        "problem_details": {"test": {"test_cases": [{"case_id": 1, "inputs": {"a": [1, None]}, "output": {"re": 1}, "tolerance": 2}]}},
    }
    records = spark.createDataFrame([(1, json.dumps(doc))], "record_id bigint, record_json string")
    nested.write(records, str(tmp_path / "t"))
    read = lambda tag: {r.child_key: r for r in nested.read(spark, str(tmp_path / "t"), tag).collect()}
    grades = read("gradings")
    assert (grades["0"]["index"], grades["0"].problem_quality, grades["0"].seed_correspondence, grades["0"].output_seed_correspondence_comment) == (0, None, 5, "c")
    assert json.loads(grades["0"].other) == {"problem_quality": "80", "extra": [1]} and grades["1"].value == "7" and grades["2"].value == '"plain"'
    models = read("models")
    assert models["0"].value == '"text"' and models["1"].model is None and json.loads(models["1"].other) == {"model": 3}
    case = read("test_cases")["0"]
    assert json.loads(case.output) == {"re": 1} and json.loads(case.inputs) == {"a": [1, None]} and case.tolerance == 2.0 and read("case_inputs")["a"].value == "[1, null]"
    assert read("verdicts") == {}


def test_a_cluster_must_name_its_shared_folder(spark):
    import pytest

    from sievework import session

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        session.shared_dir(Elsewhere)
