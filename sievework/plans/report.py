"""The report: tables of metrics (small, already aggregated) as LaTeX, and problem sections written where the rows are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import escaped, escaped_text, report_text
from sievework.operators import verdicts
from sievework.sources.sinks import write_text

HEAD = "\\documentclass{article}\n\\usepackage{amsmath,booktabs}\n\\begin{document}\n"
TAIL = "\\end{document}\n"


def table_of(metrics: DataFrame, title: str, most: int = 500) -> str:
    """A table of a metrics frame: one row per group; more than ``most`` groups are an error, not cut off."""
    rows = metrics.take(most + 1)
    if len(rows) > most:
        raise ValueError(f"{title}: more than {most} rows are no table for a page")
    show = lambda v: "--" if v is None else f"{v:.3f}" if isinstance(v, float) else escaped(str(v))
    names = " & ".join(escaped(c) or "" for c in metrics.columns)
    body = "".join(" & ".join(show(v) for v in row) + " \\\\\n" for row in rows)
    return f"\\section*{{{escaped(title)}}}\n\\begin{{tabular}}{{{'l' * len(metrics.columns)}}}\n\\toprule\n{names} \\\\\n\\midrule\n{body}\\bottomrule\n\\end{{tabular}}\n"


def document(tables: dict[str, DataFrame]) -> str:
    return HEAD + "\n".join(table_of(df, title) for title, df in tables.items()) + TAIL


def problem_sections(problems: DataFrame, title: Column, statement: Column, solution: Column, keep: Sequence[str] = ()) -> DataFrame:
    """A LaTeX section per problem, beside the columns to keep; text is converted and escaped where it is."""
    body = F.concat(F.lit("\\section{"), title, F.lit("}\n"), escaped_text(report_text(F.coalesce(statement, F.lit("")))), F.lit("\n\\subsection*{Solution}\n"), escaped_text(report_text(F.coalesce(solution, F.lit("")))), F.lit("\n"))
    return problems.select(*keep, body.alias("section"))


def selected_attempts(attempts: DataFrame, n: int | None = None, correct_only: bool = False) -> DataFrame:
    """Attempts for a report: the first n of each model, only right ones if asked; best models first.

    ``attempts``: problem_key, model, attempt_ord, verified.
    """
    kept = attempts if n is None else attempts.where(F.col("attempt_ord") <= n)
    rate = kept.groupBy("problem_key", "model").agg(F.coalesce(F.avg(F.when(F.col("verified") == 1, 1.0).otherwise(0.0)), F.lit(0.0)).alias("accuracy"))
    kept = kept.where("verified = 1") if correct_only else kept
    return kept.join(rate, ["problem_key", "model"]).orderBy("problem_key", F.desc("accuracy"), "model", "attempt_ord")


def evaluation(attempts: DataFrame, problems: DataFrame, n: int | None = None, models: Sequence[str] = (), pivot: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Title -> table of a report, from attempts (problem_key, model, level, attempt_ord, verified).

    ``models`` chooses what is shown, not what is counted; ``pivot`` names two models to set side by side.
    """
    kept = attempts if n is None else attempts.where(F.col("attempt_ord") <= n)
    shown = lambda df: df.where(F.col("model").isin(*models)) if models else df
    tables = {"Verdicts by model": shown(verdicts.verification_metrics(kept)).orderBy("model"), "Best of n by model": shown(verdicts.best_of_n(kept)).orderBy("model")}
    by_level = kept.groupBy("level", "model").agg(F.avg("verified").alias("mean_score"), F.count_distinct("problem_key").alias("sample_size"))
    tables["Models by level"] = shown(by_level).orderBy(*verdicts.level_order(F.col("level")), "model")
    if len(pivot) == 2:
        tables["Problems by model"] = verdicts.per_problem_pivot(kept, pivot).orderBy("problem_key")
    return tables


def write_report(tables: dict[str, DataFrame], sections: DataFrame | None, path: str) -> None:
    """The report's tables as one document, and problem sections (any number) beside it, written where the rows are."""
    write_text(document(tables), path)
    if sections is not None:
        sections.select("section").write.mode("overwrite").text(path.rsplit(".", 1)[0] + "_problems")
