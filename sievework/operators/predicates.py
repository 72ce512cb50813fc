"""Row predicates: routing, resuming, seed validity, model families, input safety."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import strip

#: Prefixes of model names that are served by an interface, and by which family.
FAMILIES = {"openai": ("chatgpt", "gpt-", "o1", "o3", "o4"), "deepseek": ("deepseek",), "claude": ("claude",), "gemini": ("gemini",), "moonshot": ("moonshotai",), "grok": ("grok",)}
LOCAL_PREFIX = "deepseek-ai/DeepSeek-R1-Distill"
HOSTED = ("openai/gpt-oss-20b", "openai/gpt-oss-120b")
SHARED_HOST = ("deepseek", "moonshotai", "openai/gpt-oss-120b")


def is_remote(model: Column, custom_url: bool = False) -> Column:
    """Whether a model is called over an interface rather than loaded here."""
    if custom_url:
        return F.lit(True)
    known = F.lit(False)
    for prefixes in FAMILIES.values():
        for prefix in prefixes:
            known = known | model.startswith(prefix)
    return F.coalesce((known & ~model.startswith(LOCAL_PREFIX)) | model.isin(*HOSTED), F.lit(False))


def family(model: Column) -> Column:
    """The provider family of a model name; "local" for all others, null for null."""
    out = F.when(model.startswith(LOCAL_PREFIX), "local").when(model.isin(*HOSTED), "hosted")
    for name, prefixes in FAMILIES.items():
        for prefix in prefixes:
            out = out.when(model.startswith(prefix), name)
    return out.when(model.isNotNull(), "local")


def on_shared_host(model: Column) -> Column:
    out = F.lit(False)
    for prefix in SHARED_HOST:
        out = out | model.startswith(prefix)
    return F.coalesce(out & ~model.startswith(LOCAL_PREFIX), F.lit(False))


def included(topic: Column, include: Sequence[str] | None, exclude: Sequence[str] = ()) -> Column:
    """In the include list if there is one, and not in the exclude list; a null topic passes only without an include list."""
    kept = F.lit(True) if include is None else F.coalesce(topic.isin(*include), F.lit(False))
    return kept & ~F.coalesce(topic.isin(*exclude), F.lit(False)) if exclude else kept


def solved(results: Column, model: str | None = None) -> Column:
    """Of a map model -> {passed, ...}: the model's outcome, or any model's; false where there is none."""
    one = F.try_element_at(results, F.lit(model))["passed"] if model else F.exists(F.map_values(results), lambda r: F.coalesce(r["passed"], F.lit(False)))
    return F.coalesce(one, F.lit(False))


def to_resume(passed: Column, used: Column, most: int, again: bool = False) -> Column:
    """Work that is neither passed nor out of attempts; all of it when done again."""
    return F.lit(True) if again else ~(F.coalesce(passed, F.lit(False)) | (F.coalesce(used, F.lit(0)) >= most))


def to_regrade(normalised: Column, everything: bool = False) -> Column:
    """Attempts without a verdict, or all."""
    return F.lit(True) if everything else F.coalesce(F.size(normalised) <= 0, F.lit(True))


def lacks_tests(test: Column, force: bool = False, update: bool = False) -> Column:
    """Documents a test stage reads: those without tests, all if forced, those with tests when updating outputs."""
    return F.lit(True) if force else test.isNotNull() if update else test.isNull()


def valid_pairs(pairs: DataFrame, problem: str = "problem", solution: str = "solution") -> DataFrame:
    """Pairs of which both texts have content; white space of any kind is none."""
    return pairs.where((F.length(strip(F.col(problem))) > 0) & (F.length(strip(F.col(solution))) > 0))


def with_status(df: DataFrame, ok: Column, failed: str, status: str = "status") -> DataFrame:
    """Routes rows to a status partition; a predicate that is null (broken rows) fails."""
    before = F.col(status) if status in df.columns else F.lit("ok")
    return df.withColumn(status, F.when(before != "ok", before).when(F.coalesce(ok, F.lit(False)), "ok").otherwise(failed))


def safe_inputs(inputs: Column, risks: Column, allowed: Column | None = None) -> Column:
    """map<string,double> inputs against map<string,array<string>> risks.

    A value near 0 fails where it divides, a negative one under a factorial, one at or
    below 0 under a root or logarithm; with ``allowed`` (map<string,array<double>>) a value must be listed.
    """

    def ok(entry: Column) -> Column:
        value, of = entry["value"], F.coalesce(F.try_element_at(risks, entry["key"]), F.array().cast("array<string>"))
        bad = (F.array_contains(of, "division_by_zero") & (F.abs(value) < 1e-9)) | (F.array_contains(of, "negative_factorial") & (value < 0)) | (F.array_contains(of, "domain_error") & (value <= 0))
        if allowed is not None:
            listed = F.try_element_at(allowed, entry["key"])
            bad = bad | (listed.isNotNull() & ~F.array_contains(listed, value))
        return ~F.coalesce(bad, F.lit(False))

    return F.coalesce(F.forall(F.map_entries(inputs), ok), F.lit(True))
