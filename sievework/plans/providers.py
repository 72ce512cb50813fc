"""Model calls behind one interface. No vendor code: plug a Provider in; the stub answers offline, alike every time."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
from collections.abc import Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.predicates import FAMILIES


class Provider(Protocol):
    """Anything that can be pickled and turns a prompt into text."""

    def __call__(self, prompt: str, model: str, system: str | None = None) -> str: ...


class BatchProvider(Protocol):
    """Anything that can be pickled and answers many prompts at once, in order."""

    def batch(self, prompts: list[str], model: str) -> list[str]: ...


class Stub:
    """Answers from a hash of its input; ``test-model`` gives full marks to whatever it grades."""

    def batch(self, prompts: list[str], model: str) -> list[str]:
        return [self(p, model) for p in prompts]

    def __call__(self, prompt: str, model: str, system: str | None = None) -> str:
        if model == "test-model":
            return json.dumps({k: 100 for k in ("problem_quality", "solution_completeness", "solution_quality", "test_case_quality")})
        n = int(hashlib.md5(f"{model}\n{system or ''}\n{prompt}".encode()).hexdigest()[:8], 16)
        if prompt.startswith("Correct the function"):
            code = prompt.rsplit("CODE\n", 1)[-1]
            return "```python\n" + re.sub(r"\)\s*(->[^:]*)?:\s*\n(?:.|\n)*", r")\1:\n    return 0\n", code, count=1) + "```"
        return f"\\section{{Problem Statement}}\nCompute f({n % 97}).\n\\section{{Solution}}\nBy definition.\n\\section{{Answer}}\n{n % 97 + 1}\n\\section{{Code}}\n```python\ndef f(x: int) -> int:\n    return x + 1\n```\n"


#: Where keys are looked up, by family of the model's name.
KEY_NAME = "SIEVEWORK_KEY_{}"


def key_for(model: str, files: Sequence[str] = ()) -> str | None:
    """The key of a model's family: from the environment, else from the first of some key files (NAME=VALUE lines, or the key alone)."""
    name = KEY_NAME.format(next((family for family, starts in FAMILIES.items() if model.startswith(starts)), "local").upper())
    if os.environ.get(name):
        return os.environ[name]
    for path in files:
        try:
            with open(path, encoding="utf-8") as f:
                lines = [line.strip() for line in f if line.strip() and not line.startswith("#")]
        except OSError:
            continue
        named = dict(line.split("=", 1) for line in lines if "=" in line)
        if name in named:
            return named[name].strip()
        if len(lines) == 1 and "=" not in lines[0]:
            return lines[0]
    return None


def call_batches(df: DataFrame, provider: BatchProvider, prompt: str, model: str, out: str = "response", size: int = 500) -> DataFrame:
    """``df`` with ``out`` and ``error``: calls by batches of one model, answers in the order of the prompts.

    A batch that fails, or answers with another number of texts, gives all of its rows the error.
    """
    kept = [c for c in df.columns if c not in (out, "error")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept), f"`{out}` string, error string"])

    def run(frames):
        for frame in frames:
            for name, rows in frame.groupby(model, dropna=False, sort=False):
                for a in range(0, len(rows), size):
                    some = rows.iloc[a : a + size][kept].copy()
                    try:
                        texts, error = list(provider.batch([p or "" for p in some[prompt]], name if isinstance(name, str) else "")), None
                        if len(texts) != len(some):
                            texts, error = [None] * len(some), f"{len(texts)} answers to {len(some)} prompts"
                    except Exception as e:
                        texts, error = [None] * len(some), f"{type(e).__name__}: {e}"[:300]
                    some[out], some["error"] = pd.Series(texts, dtype=object, index=some.index), pd.Series([error] * len(some), dtype=object, index=some.index)
                    yield some

    return df.select(*(F.col(f"`{c}`") for c in kept)).mapInPandas(run, schema)


def call(df: DataFrame, provider: Provider, prompt: str, model: str, out: str = "response", tries: int = 3, per_minute: float | None = None) -> DataFrame:
    """``df`` with ``out`` and ``error``: one call per row, up to ``tries`` times, at a steady rate per partition.

    Put filters before this: they are not pushed through it. Write the result before using it twice.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in (out, "error")), f"`{out}` string, error string"])
    kept = [c for c in df.columns if c not in (out, "error")]

    def run(frames):
        for frame in frames:
            texts, errors = [], []
            for p, m in zip(frame[prompt], frame[model]):
                text, error = None, None
                for _ in range(tries):
                    try:
                        if per_minute:
                            time.sleep(60.0 / per_minute)
                        text, error = provider(p or "", m or ""), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"[:300]
                texts.append(text)
                errors.append(error)
            frame = frame[kept].copy()
            frame[out], frame["error"] = pd.Series(texts, dtype=object, index=frame.index), pd.Series(errors, dtype=object, index=frame.index)
            yield frame

    return df.select(*(F.col(f"`{c}`") for c in kept)).mapInPandas(run, schema)
