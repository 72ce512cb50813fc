"""Comparison of outputs: numbers within an absolute tolerance, containers by element, the rest by equality."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TOLERANCE = 1e-6


def close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """|a - b| <= tolerance, inclusive; NaN and differences of infinities are unequal; a null is unequal."""
    gap = F.abs(a.cast("double") - b.cast("double"))
    return F.coalesce((gap <= tolerance) & ~F.isnan(gap), F.lit(False))


def close_lists(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Arrays of numbers: same length, all elements close."""
    same = F.size(a) == F.size(b)
    return F.coalesce(same & F.forall(F.zip_with(a, b, lambda x, y: close(x, y, tolerance)), lambda ok: ok), F.lit(False))


def finite(value: Column) -> Column:
    """A double, or null where it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def finite_text(value: Column) -> Column:
    """A string, or null where it only names something that is not finite."""
    return F.when(~F.lower(value).isin("inf", "-inf", "nan", "infinity", "-infinity"), value)


NOT_FINITE = frozenset(("inf", "-inf", "nan", "infinity", "-infinity"))


def scrubbed(value: Any) -> Any:
    """A nested value with null for numbers that are not finite and strings that only name one, at every depth."""
    if isinstance(value, dict):
        return {k: scrubbed(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [scrubbed(v) for v in value]
    if hasattr(value, "tolist"):
        return scrubbed(value.tolist())
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return None if isinstance(value, str) and value.lower() in NOT_FINITE else value


@F.pandas_udf(StringType())
def scrubbed_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON text scrubbed; null for text that is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(scrubbed(json.loads(text)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    for batch in batches:
        yield batch.map(one)


def number_of(value: Any) -> complex | None:
    """A number, or a string that names one (i stands for j); None for anything else."""
    if isinstance(value, (bool, int, float, complex)):
        return complex(value)
    if isinstance(value, dict) and set(value) == {"re", "im"} and None not in value.values():
        return complex(value["re"], value["im"])
    if isinstance(value, str):
        try:
            return complex(value.strip().strip("()").replace(" ", "").replace("i", "j")) if not value.strip().lower().startswith(("inf", "nan", "-inf")) else complex(float(value))
        except ValueError:
            return None
    return None


def alike(a: Any, b: Any, tolerance: float = TOLERANCE, compat: bool = False) -> bool:
    """Any two JSON values. Two nulls are equal unless ``compat``, which keeps the older rule that they are not."""
    if a is None or b is None:
        return a is None and b is None and not compat
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(alike(x, y, tolerance, compat) for x, y in zip(a, b))
    if isinstance(a, dict) and isinstance(b, dict) and set(a) != {"re", "im"}:
        return set(a) == set(b) and all(alike(a[k], b[k], tolerance, compat) for k in a)
    x, y = number_of(a), number_of(b)
    if x is not None and y is not None:
        gap = abs(x - y)
        return not math.isnan(gap) and gap <= tolerance
    return type(a) is type(b) and a == b


def rounded(value: Any, tolerance: float = TOLERANCE) -> str:
    """Numbers with the decimals the tolerance leaves; containers element by element."""
    digits = max(0, round(-math.log10(tolerance))) if tolerance > 0 else 6
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k}: {rounded(v, tolerance)}" for k, v in value.items()) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(rounded(v, tolerance) for v in value) + "]"
    number = number_of(value) if not isinstance(value, str) else None
    if number is None:
        return str(value)
    return f"{number.real:.{digits}f}" if number.imag == 0 else f"{number.real:.{digits}f}{number.imag:+.{digits}f}j"


def parsed(text: str | None) -> Any:
    if text is None:
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


def alike_udf(tolerance: float = TOLERANCE, compat: bool = False):
    """(JSON text, JSON text) -> boolean, for values no column type can hold."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([alike(parsed(x), parsed(y), tolerance, compat) for x, y in zip(a, b)])

    return run
