"""Test cases: made by rule or read from model output, run, graded, repaired."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import code as C
from sievework.functions import sandbox
from sievework.functions.text import first_object, last_code
from sievework.operators.compare import TOLERANCE, alike, parsed
from sievework.plans import prompts
from sievework.plans.providers import Provider, call
from sievework.session import cut

CASES = "array<struct<case_id:int,inputs:string>>"
RESULTS = "array<struct<case_id:int,output:string,output_type:string>>"


def inputs_for(code: str, problem_id: str, count: int = 5) -> list[dict]:
    """Inputs of ``count`` cases by the types of the first function, alike for equal ids."""
    import ast

    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return []
    head = next((n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)), None)
    if head is None:
        return []
    doc = ast.get_docstring(head) or ""
    kinds = {a.arg: (ast.unparse(a.annotation).split("[")[0] if a.annotation else "float") for a in head.args.args}
    risks = C.unsafe_operations(code, list(kinds))
    out = []
    for case in range(count):
        draw = np.random.default_rng(int.from_bytes(f"{problem_id}:{case}".encode(), "little") % 2**63)
        inputs = {}
        for name, kind in kinds.items():
            choices = C.documented_values(doc, name) or C.string_keys(code, name) if kind == "str" else None
            value = choices[case % len(choices)] if choices else C.test_value(kind, draw)
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                if "domain_error" in risks[name] or "negative_factorial" in risks[name]:
                    value = abs(value) or 1
                if "division_by_zero" in risks[name] and abs(value) < 1e-9:
                    value = 1
            inputs[name] = value
        out.append({"case_id": case + 1, "inputs": json.dumps(inputs)})
    return out


def from_response(text: str | None, args: list[str]) -> list[dict] | None:
    """Cases of a model's answer, numbered from 1; None if any lacks an argument; others are dropped."""
    body = first_object(text)
    try:
        cases = json.loads(body or "")["test_cases"]
        made = [{a: case["inputs"][a] for a in args} for case in cases]
    except (ValueError, KeyError, TypeError):
        return None
    return [{"case_id": k + 1, "inputs": json.dumps(c)} for k, c in enumerate(made)] or None


def response_cases(df: DataFrame, id_col: str, text_col: str, args: list[str]) -> DataFrame:
    """(id, cases) of models' answers; null where an answer holds no cases or any lacks an argument."""

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "cases": pd.Series([from_response(t, args) for t in frame["text"]], dtype=object)})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, cases {CASES}").withColumnRenamed("id", id_col)


def spread(df: DataFrame, *together: str) -> DataFrame:
    """Rows that each start processes, dealt out over all cores: what they carry is small against what they cost. Rows that agree in ``together`` are neighbours."""
    tasks = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, *together).sortWithinPartitions(*together) if together else df.repartition(tasks)


def synthesize(df: DataFrame, id_col: str, code_col: str, count: int = 5) -> DataFrame:
    """(id, case_id, inputs as JSON) for every problem with a function."""

    def run(frames):
        for frame in frames:
            rows = [(i, c["case_id"], c["inputs"]) for i, code in zip(frame["id"], frame["code"]) for c in inputs_for(code, i, count)]
            yield pd.DataFrame(rows, columns=["id", "case_id", "inputs"])

    return df.select(F.col(id_col).cast("string").alias("id"), F.col(code_col).alias("code")).mapInPandas(run, "id string, case_id int, inputs string").withColumnRenamed("id", id_col)


def execute(df: DataFrame, id_col: str, code_col: str, cases_col: str, seconds: float = 10.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, error, results) of code on its cases, each problem in a child process; then the columns ``keep`` as they were."""

    def run(frames):
        with sandbox.Sandbox() as box:
            for frame in frames:
                given = [c if c is not None else [] for c in frame["cases"]]
                ran = box.run_all([call_of(code, code, cases) for code, cases in zip(frame["code"], given)], seconds)
                errors = [r["error"] for r in ran]
                results = [[{"case_id": int(c["case_id"]), "output": json.dumps(r["output"]), "output_type": r["type"]} for c, r in zip(cases, got["results"])] for cases, got in zip(given, ran)]
                out = frame[["id", *kept]].copy()
                out["error"], out["results"] = pd.Series(errors, dtype=object, index=out.index), pd.Series(results, dtype=object, index=out.index)
                yield out

    kept = {f"_{k}": c for k, c in enumerate(keep)}
    source = df.select(F.col(id_col).alias("id"), F.col(code_col).alias("code"), F.col(cases_col).cast(CASES).alias("cases"), *(F.col(c).alias(k) for k, c in kept.items()))
    schema = ", ".join([f"id {df.schema[id_col].dataType.simpleString()}, error string, results {RESULTS}", *(f"{k} {df.schema[c].dataType.simpleString()}" for k, c in kept.items())])
    return spread(source).mapInPandas(run, schema).select(F.col("id").alias(id_col), "error", "results", *(F.col(k).alias(c) for k, c in kept.items()))


def call_of(standard: str | None, code: str | None, cases: list | None) -> tuple[str | None, list[dict], dict[str, str]]:
    """A call of the sandbox: code on inputs as the types of the standard function's arguments."""
    kinds = C.argument_types(standard)
    return code, [typed_inputs(parsed(c["inputs"]), standard, kinds) for c in (cases if cases is not None else [])], kinds


def typed_inputs(inputs: object, code: str | None, kinds: dict[str, str] | None = None) -> dict:
    """Inputs as the types of the function's arguments, those that cannot be converted as they are; none if they are no object.

    Complex numbers, tuples and arrays stay in their JSON form: the child process makes them.
    """
    kinds = C.argument_types(code) if kinds is None else kinds
    if not isinstance(inputs, dict):
        return {}
    return {name: C.coerced(value, kinds[name]) if kinds.get(name) in ("int", "float", "bool") and value is not None else value for name, value in inputs.items()}


def repair(df: DataFrame, provider: Provider, model: str, id_col: str = "problem_id", code_col: str = "code", cases_col: str = "cases", reviews_col: str | None = None, rounds: int = 3) -> DataFrame:
    """(id, code, error, results, repairs): code run on its cases; where that fails a model corrects it, ``rounds`` times at most.

    Code that runs is never sent; with ``reviews_col`` (an array of comments) all is sent once, with them.
    """
    reviews = F.col(reviews_col) if reviews_col else F.lit(None).cast("array<string>")
    now = df.select(F.col(id_col).alias("id"), F.col(code_col).alias("code"), F.col(cases_col).cast(CASES).alias("cases"), reviews.alias("reviews"))
    out: DataFrame | None = None
    for turn in range(rounds + 1):
        held = cut(execute(now, "id", "code", "cases", keep=("code", "cases", "reviews")).withColumn("repairs", F.lit(turn)))
        wanted = F.col("error").isNotNull() | ((F.lit(turn) == 0) & (F.coalesce(F.size("reviews"), F.lit(0)) > 0))
        done = held if turn == rounds else held.where(~wanted)
        done = done.select("id", "code", "error", "results", "repairs")
        out = done if out is None else out.unionByName(done)
        if turn == rounds:
            break
        asked = held.where(wanted).select("id", "code", "cases", "reviews", prompts.repair(F.col("code"), F.col("error"), F.col("reviews")).alias("prompt"), F.lit(model).alias("model"))
        if asked.isEmpty():
            break
        said = call(asked, provider, "prompt", "model", out="response")
        now = cut(said.select("id", F.coalesce(last_code(F.col("response")), F.col("code")).alias("code"), "cases", "reviews"))
    return out.withColumnRenamed("id", id_col)


def updated_outputs(df: DataFrame, id_col: str, code_col: str, cases_col: str) -> DataFrame:
    """(id, error, cases): each case with the output its code gives now; cases stay as they are where the code fails.

    ``cases_col``: array<struct<case_id, inputs, output, output_type>>.
    """
    bare = F.transform(cases_col, lambda c: F.struct(c["case_id"].alias("case_id"), c["inputs"].alias("inputs")))
    ran = execute(df.select(F.col(id_col).alias("id"), F.col(code_col).alias("code"), bare.alias("bare"), F.col(cases_col).alias("cases")), "id", "code", "bare", keep=("cases",))
    new = F.transform("cases", lambda c: F.struct(c["case_id"].alias("case_id"), c["inputs"].alias("inputs"), *(F.coalesce(F.try_element_at(F.filter("results", lambda r: r["case_id"] == c["case_id"]), F.lit(1))[x], c[x]).alias(x) for x in ("output", "output_type"))))
    return ran.select(F.col("id").alias(id_col), "error", F.when(F.col("error").isNull(), new).otherwise(F.col("cases")).alias("cases"))


def standard_runs(df: DataFrame, standard_col: str, cases_col: str, out: str, seconds: float = 12.0) -> DataFrame:
    """``df`` with ``out``: what the standard code gives on its cases, as JSON; for ``grade`` where the same rows are graded again and again."""

    def run(frames):
        with sandbox.Sandbox() as box:
            for frame in frames:
                made = [json.dumps(r) for r in box.run_all([call_of(code, code, cases) for code, cases in zip(frame[standard_col], frame[cases_col])], seconds)]
                yield frame.assign(**{out: pd.Series(made, dtype=object, index=frame.index)})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{out}` string"])
    return spread(df).mapInPandas(run, schema)


def grade(df: DataFrame, keys: list[str], standard_col: str, attempt_col: str, cases_col: str, seconds: float = 12.0, tolerance: float = TOLERANCE, together: tuple[str, ...] = (), ran_col: str | None = None) -> DataFrame:
    """keys, verified (1, 0), error, matches per case: the attempt's function against the standard one's.

    The standard code runs once for each distinct (code, cases) of a batch; keys ``together``, if they tell standards apart
    and no value has very many attempts, bring its attempts into one batch. With ``ran_col`` (see ``standard_runs``) it doesn't run.
    """

    def run(frames):
        with sandbox.Sandbox() as box:
            for frame in frames:
                calls = [call_of(standard, standard, cases) for standard, cases in zip(frame["_s"], frame["_c"])]
                at = [(code, json.dumps(inputs)) for code, inputs, _ in calls]
                known = {k: json.loads(ran) for k, ran in zip(at, frame["_r"]) if isinstance(ran, str)}
                first = {k: call for k, call in zip(at, calls) if k not in known}
                known |= zip(first, box.run_all(list(first.values()), seconds))
                tried = [k for k in range(len(at)) if not known[at[k]]["error"]]
                ran = dict(zip(tried, box.run_all([(frame["_a"].iloc[k], *calls[k][1:]) for k in tried], seconds)))
                verified, errors, matches = [], [], []
                for k, want in enumerate(map(known.get, at)):
                    got = ran.get(k, {"error": None, "results": []})
                    error = f"standard: {want['error']}" if want["error"] else got["error"]
                    same = [alike(a["output"], b["output"], tolerance) for a, b in zip(want["results"], got["results"])]
                    verified.append(int(not error and bool(same) and all(same)))
                    errors.append(error)
                    matches.append(same)
                out = frame[keys].copy()
                out["verified"], out["error"], out["matches"] = verified, pd.Series(errors, dtype=object, index=out.index), pd.Series(matches, index=out.index)
                yield out

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", verified int, error string, matches array<boolean>"
    ran = F.col(ran_col) if ran_col else F.lit(None).cast("string")
    source = df.select(*keys, F.col(standard_col).alias("_s"), F.col(attempt_col).alias("_a"), F.col(cases_col).cast(CASES).alias("_c"), ran.alias("_r"))
    return spread(source, *together).mapInPandas(run, schema)
