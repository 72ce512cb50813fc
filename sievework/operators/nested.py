"""Nested records to related flat tables by single-pass tagged emission.

A depth-first visitor goes through each document once and emits a row for every nested
element: the tag of its table, its key, its parent's key, and its payload as JSON. The
stream is written once, partitioned by tag; each table is read back with its own schema.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import scratch

EMITTED = "record_id bigint, tag string, parent_key string, child_key string, payload string"

#: Fields of each table's payload; what is of more than one shape stays JSON text (type json).
#: ``value`` is an element that is no object, ``other`` the fields that are not listed or of another type.
FIELDS = {
    "test_cases": {"case_id": "bigint", "inputs": "json", "output": "json", "output_type": "string", "tolerance": "double"},
    "case_inputs": {},
    "gradings": {
        "index": "bigint", "timestamp": "string",
        "problem_quality": "bigint", "problem_quality_comment": "string", "solution_completeness": "bigint", "solution_completeness_comment": "string",
        "solution_quality": "bigint", "solution_quality_comment": "string", "test_case_quality": "bigint", "test_case_quality_comment": "string",
        "seed_correspondence": "bigint", "seed_correspondence_comment": "string", "output_seed_correspondence": "bigint", "output_seed_correspondence_comment": "string",
    },
    "models": {"model": "string"},
    "attempts": {"timestamp": "string", "prompt_type": "string", "detailed_solution": "string"},
    "verdicts": {"verified": "bigint", "error": "string", "timestamp": "string", "matched_code": "string", "details": "json"},
    "verdict_cases": {"inputs": "json", "standard_output": "json", "attempt_output": "json", "matches": "boolean", "tolerance_used": "double"},
}
#: Keys of an element that are tables of their own.
NESTED_KEYS = {"models": {"attempts"}, "attempts": {"verifier_result"}, "verdicts": {"test_cases"}}
PYTHON = {"bigint": int, "double": float, "string": str, "boolean": bool}


def schema_of(tag: str) -> str:
    """The payload's schema in DDL."""
    named = ", ".join(f"`{name}` {'string' if kind == 'json' else kind}" for name, kind in FIELDS[tag].items())
    return ", ".join(x for x in (named, "`value` string", "`other` string") if x)


def content(value: Any) -> Any:
    """A string that holds a JSON object or array stands for it; any other string for itself."""
    for _ in range(3):
        if not isinstance(value, str):
            break
        text = value.strip()
        if text[:1] not in ("{", "[", '"'):
            break
        try:
            value = json.loads(text)
        except (ValueError, RecursionError):
            break
    return value


def elements(value: Any) -> Iterator[tuple[int, Any]]:
    """(position, element) of an array without its nulls; a single object is an array of one."""
    value = content(value)
    if isinstance(value, dict):
        yield 0, value
    elif isinstance(value, list):
        for position, element in enumerate(value):
            element = content(element)
            if element is not None:
                yield position, element


def member(value: Any, *path: str) -> Any:
    """value[path...], with strings that hold JSON opened; None where anything is missing."""
    for name in path:
        value = content(value)
        if not isinstance(value, dict):
            return None
        value = value.get(name)
    return content(value)


def top_object(text: str | None) -> dict[str, Any] | None:
    """The first JSON value of a text if it is an object; what follows it is ignored."""
    if not text:
        return None
    try:
        value, _ = json.JSONDecoder().raw_decode(text.lstrip("﻿ \t\r\n"))
    except (ValueError, RecursionError):
        return None
    value = content(value)
    return value if isinstance(value, dict) else None


def fits(value: Any, kind: str) -> bool:
    """Whether a JSON value is of a field's type as it stands."""
    if kind == "json":
        return True
    if kind == "double":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, PYTHON[kind]) and not (kind == "bigint" and isinstance(value, bool)) and not (kind == "bigint" and abs(value) >= 1 << 63)


def payload(tag: str, value: Any) -> str:
    """The element as JSON text of the table's fields; nothing is lost: what has no field goes to ``value`` or ``other``."""
    dump = lambda x: json.dumps(x, ensure_ascii=False)
    if tag == "case_inputs" or not isinstance(value, dict):
        return dump({"value": dump(value)})
    out, other = {}, {}
    fields, skip = FIELDS[tag], NESTED_KEYS.get(tag, ())
    for name, x in value.items():
        if name in skip or x is None:
            continue
        kind = fields.get(name)
        if kind is None or not fits(x, kind):
            other[name] = x
        else:
            out[name] = x if kind != "json" or isinstance(x, str) else dump(x)
    if other:
        out["other"] = dump(other)
    return dump(out)


def visit(document: dict[str, Any]) -> Iterator[tuple[str, str, str, Any]]:
    """(tag, parent key, child key, element) of every nested element, depth first."""
    for case, body in elements(member(document, "problem_details", "test", "test_cases")):
        yield "test_cases", "", str(case), body
        inputs = member(body, "inputs")
        if isinstance(inputs, dict):
            for name, value in inputs.items():
                yield "case_inputs", str(case), name, value
    gradings = member(document, "quality_gradings")
    if isinstance(gradings, dict):
        for grader, grades in gradings.items():
            for position, grade in elements(grades):
                yield "gradings", grader, str(position), grade
    for model, body in elements(member(document, "model_solutions")):
        yield "models", "", str(model), body
        for attempt, solution in elements(member(body, "attempts")):
            yield "attempts", str(model), str(attempt), solution
            for verdict, result in elements(member(solution, "verifier_result")):
                if result == {}:
                    continue
                yield "verdicts", f"{model}/{attempt}", str(verdict), result
                for case, compared in elements(member(result, "test_cases")):
                    yield "verdict_cases", f"{model}/{attempt}/{verdict}", str(case), compared


def emit(records: DataFrame, id_col: str = "record_id", json_col: str = "record_json") -> DataFrame:
    """(record_id, tag, parent_key, child_key, payload): one row per nested element.

    Null records and records that end too early give no rows; text after the top object is
    ignored; null elements give no row but keep their position; repeated records repeat
    their rows. Narrow: every document is parsed once, where it is.
    """

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), 200):
                rows = []
                for record, text in zip(frame["id"].iloc[start : start + 200], frame["doc"].iloc[start : start + 200]):
                    document = top_object(text)
                    if document is not None:
                        rows.extend((record, tag, parent, child, payload(tag, body)) for tag, parent, child, body in visit(document))
                yield pd.DataFrame(rows, columns=["record_id", "tag", "parent_key", "child_key", "payload"])

    source = records.select(F.col(id_col).cast("bigint").alias("id"), F.col(json_col).cast("string").alias("doc"))
    return source.mapInPandas(run, EMITTED)


def found(records: DataFrame) -> DataFrame:
    """(record_id, child_table, parent_key, child_key) of every nested element, from the stream as it was written by tag."""
    path = scratch(records.sparkSession, "nested")
    write(records, path)
    stored = records.sparkSession.read.schema(f"{STORED}, tag string").parquet(path)
    return stored.select("record_id", F.col("tag").alias("child_table"), "parent_key", "child_key")


STORED = "record_id bigint, parent_key string, child_key string, payload string"


def typed(emitted: DataFrame, tag: str) -> DataFrame:
    """One table of the stream under its schema."""
    fields = F.from_json("payload", schema_of(tag), {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})
    return emitted.where(F.col("tag") == tag).select("record_id", "parent_key", "child_key", fields.alias("f")).select("record_id", "parent_key", "child_key", "f.*")


def write(records: DataFrame, path: str) -> None:
    """The stream of all tables, written once, partitioned by tag."""
    emit(records).write.mode("overwrite").partitionBy("tag").parquet(path)


def read(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """One table back from ``write``: only its partition is read. A table without rows is empty."""
    return typed(spark.read.schema(f"{STORED}, tag string").parquet(path), tag)


def flattened(records: DataFrame, tag: str) -> DataFrame:
    """One table of the records, through the stored stream."""
    path = scratch(records.sparkSession, "nested")
    write(records, path)
    return read(records.sparkSession, path, tag)
