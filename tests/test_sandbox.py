"""Candidate code in forked children: cheap, apart from each other, and of the same outcome as in a process of its own."""

import json
import time

from pyspark.sql import functions as F

from sievework.functions import sandbox
from sievework.plans import cases, pipeline
from tests.test_plans import GOOD, Scripted

#: The module os, by a way that the few names leave open.
OS = "[m for k, m in __import__.__globals__['sys'].modules.items() if k == 'os'][0]"


def test_many_calls_cost_one_start():
    began = time.monotonic()
    with sandbox.Sandbox() as box:
        got = [box.run("def f(x):\n    return np.sqrt(x) + 1" if k % 2 else GOOD, [{"x": 4}])["results"] for k in range(400)]
        assert len(box.servers) == 2
    assert got == [[{"output": 5, "type": "int"}], [{"output": 3.0, "type": "float64"}]] * 200
    # a process of its own for each took 0.1 s
    assert time.monotonic() - began < 20


def test_children_change_nothing_for_each_other():
    one = [{"x": 1}]
    with sandbox.Sandbox() as box:
        assert box.run("math.floor = None\n__builtins__['abs'] = None\ndef f(x):\n    return math.floor", one)["results"][0]["output"] is None
        assert box.run("def f(x):\n    return math.floor(abs(-x))", one)["results"][0]["output"] == 1
        assert box.run("def f(x):\n    while True: pass", one, seconds=0.5)["error"] == "timed out"
        assert box.run(f"def f(x):\n    {OS}._exit(7)", one)["error"] == "ended with code 7"
        assert box.run("def f(x):\n    return [0] * 10**9", one)["error"] == "out of memory"
        # one that ends the server gets the error, the next a new server
        assert box.run(f"def f(x):\n    {OS}.kill({OS}.getppid(), 9)\n    while True: pass", one)["error"] == "ended with code -9"
        assert box.run("def f(x):\n    print('a\\n' * 100000)\n    return 'b'", one)["results"] == [{"output": "b", "type": "str"}]
        draw = "def f(x):\n    return float(np.random.rand())"
        assert box.run(draw, one) != box.run(draw, one)


def test_attempts_of_one_problem_are_neighbours(spark):
    df = spark.createDataFrame([(k % 50, k) for k in range(200)], "p int, a int")
    parts = [[r.p for r in part] for part in cases.spread(df, "p").rdd.glom().collect()]
    assert all(part == sorted(part) for part in parts) and all(sum(p in part for part in parts) == 1 for p in range(50))


def test_rounds_of_solving_run_the_standard_once(spark, monkeypatch):
    asked = []

    def told(df, standard_col, cases_col, out, **_):
        asked.append(out)
        # what no run of the standard gives: attempts are held against it all the same
        return df.withColumn(out, F.lit(json.dumps({"error": None, "results": [{"output": 0, "type": "int"}]})))

    rows = [(f"p{k}", s, GOOD, [(1, json.dumps({"x": 1}))]) for k, s in enumerate(["right", "wrong"])]
    problems = spark.createDataFrame(rows, "problem_id string, statement string, code string, cases array<struct<case_id:int,inputs:string>>")
    config = pipeline.Config(provider=Scripted(), max_k=2)
    assert {tuple(r) for r in pipeline.solve(problems, config).collect()} == {("p0", True, 1), ("p1", False, 2)}
    monkeypatch.setattr(cases, "standard_runs", told)
    assert {tuple(r) for r in pipeline.solve(problems, config).collect()} == {("p0", False, 2), ("p1", True, 1)}
    assert asked == ["ran"]


def test_repair_keeps_rows_of_equal_or_no_ids(spark):
    df = spark.createDataFrame([(i, GOOD, [(1, json.dumps({"x": x}))]) for i, x in (("a", 1), ("a", 5), (None, 7))], "id string, code string, cases array<struct<case_id:int,inputs:string>>")
    assert sorted(r.results[0].output for r in cases.repair(df, Scripted(), "m", "id").collect()) == ["2", "6", "8"]


def test_updated_outputs_keep_rows_of_equal_or_no_ids(spark):
    kind = "array<struct<case_id:int,inputs:string,output:string,output_type:string>>"
    df = spark.createDataFrame([(i, GOOD, [(1, json.dumps({"x": x}), "old", "str")]) for i, x in (("a", 1), ("a", 5), (None, 7))], f"id string, code string, cases {kind}")
    assert sorted(tuple(r.cases[0]) for r in cases.updated_outputs(df, "id", "code", "cases").collect()) == [(1, '{"x": 1}', "2", "int"), (1, '{"x": 5}', "6", "int"), (1, '{"x": 7}', "8", "int")]


def test_only_plain_arithmetic_shares_a_child():
    plain = ["def f(x: float) -> float:\n    '''Doc.'''\n    if x < 6 & 1 > 0:\n        return 1\n    print('%s' % (x,))\n    return math.sqrt(x) / (x + 1.5)", GOOD]
    other = [
        "x = []\ndef f(x):\n    return x", "def f(x):\n    while x: pass", "def f(x):\n    global y\n    y = x", "def f(x):\n    math.pi = 3", "def f(x, y=[]):\n    return y", "import math\ndef f(x):\n    return x",
        "def f(x):\n    return __builtins__", "def f(x):\n    return x.y", "def f(x):\n    return f(x)", "def f(x):\n    def g():\n        return 1\n    return g()", "@print\ndef f(x):\n    return x", "def f(x):\n    print(x, file=x)", "def f(x", "def abs(x):\n    return x",
    ]
    assert all(map(sandbox.plain_arithmetic, plain)) and not any(map(sandbox.plain_arithmetic, other))


def test_calls_that_share_a_child_have_the_results_of_calls_alone():
    codes = [GOOD, "def f(x: int):\n    return 1 / x", "def f(x):\n    return 'a' * 10**10", "math.floor = None\ndef f(x):\n    return 1", "def f(x):\n    return math.floor(x)", None, "def f(x", "def f(x):\n    return 10**5000"]
    calls = [(code, [{"x": x}], {}) for x in (0, 1) for code in codes]
    with sandbox.Sandbox() as box:
        assert box.run_all(calls) == [box.run(*call[:2]) for call in calls]
        slow = [("def f(x):\n    return 9 ** 9 ** 9 ** x", [{"x": 9}], {}), (GOOD, [{"x": 1}], {})]
        assert [r["error"] for r in box.run_all(slow, seconds=1)] == ["timed out", None]


def test_three_hundred_runs_need_few_children(monkeypatch):
    asked = []
    real = sandbox.Sandbox.asked
    monkeypatch.setattr(sandbox.Sandbox, "asked", lambda *a: asked.append(1) or real(*a))
    with sandbox.Sandbox() as box:
        assert [r["results"][0]["output"] for r in box.run_all([(GOOD, [{"x": k}], {}) for k in range(300)])] == list(range(1, 301))
    assert len(asked) == 6
