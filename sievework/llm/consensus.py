"""Consensus of annotators who disagree, with the reliability of each.

Feature-assisted consensus: expectation-maximisation fits, together, one confusion
matrix per annotator and a regularised logistic classifier on features of the item;
the classifier's output is the prior of the item's label. Items stay where they are:
each round sends the parameters out and brings sums back, whose size depends on the
number of annotators and features only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.nested import flattened
from sievework.session import cut

METRICS = ("problem_quality", "solution_quality")
#: Least score of a "pass" vote, and the range of scores that are votes at all.
PASS_FROM, LOWEST, HIGHEST = 80, 0, 100
FEATURES = ("bias", "completeness", "test_cases", "commented")
#: Strength of the ridge on the classifier's weights (the bias is free).
RIDGE = 25.0
#: Pseudo-counts of each row of a confusion matrix: (right, wrong).
SMOOTH = (2.0, 1.0)
ROUNDS, TOLERANCE = 60, 1e-4


def votes(grades: DataFrame, problem_col: str = "problem_key", grader_col: str = "grader_id") -> DataFrame:
    """problem, grader and the scores of the row with the greatest run_index.

    Aggregated by (problem, grader) with partial sums before the shuffle, so a problem
    with very many rows costs no more than its graders. Rows without problem or grader
    are no votes; a null run_index comes before all others; among equal run indices the
    latest graded_at, then the greatest grade_row_id counts (rows delivered again are equal).
    """
    order = F.struct(F.coalesce("run_index", F.lit(-1)), F.coalesce(F.col("graded_at").cast("string"), F.lit("")), F.col("grade_row_id"))
    kept = F.struct(*METRICS, "solution_completeness", "test_case_quality", F.col("problem_quality_comment").isNotNull().cast("double").alias("commented"))
    rows = grades.where(F.col(problem_col).isNotNull() & F.col(grader_col).isNotNull())
    last = rows.groupBy(F.col(problem_col).alias("problem_key"), F.col(grader_col).alias("grader_id")).agg(F.max_by(kept, order).alias("v"))
    return last.select("problem_key", "grader_id", "v.*")


def vote_of(metric: str):
    """1 pass, 0 fail, null no vote."""
    score = F.col(metric)
    return F.when((score >= LOWEST) & (score <= HIGHEST), (score >= PASS_FROM).cast("int"))


def from_records(records: DataFrame) -> DataFrame:
    """Grades as they lie in problem documents (problem_key, record_json), in the form of a table of grades.

    A document exported more than once repeats its grades, which are one vote all the same.
    """
    flat = flattened(records, "gradings").join(records.select("record_id", "problem_key").hint("merge"), "record_id")
    return flat.select(
        F.xxhash64("record_id", "parent_key", "child_key").alias("grade_row_id"), "problem_key", F.col("parent_key").alias("grader_id"), F.col("index").cast("int").alias("run_index"), F.col("timestamp").alias("graded_at"),
        "problem_quality", "problem_quality_comment", "solution_completeness", "solution_quality", "test_case_quality",
    )


def item_features(metadata: DataFrame) -> DataFrame:
    """(problem_key, item): features of the problem itself - length of its description, formulas and numbers in it, and whether there is one; each within -0.5 to 0.5."""
    text = F.coalesce("problem_description", F.lit(""))
    scaled = lambda x, full: F.least(x / F.lit(float(full)), F.lit(1.0)) - 0.5
    count = lambda pattern: F.size(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)))
    made = F.array(scaled(F.length(text), 1000), scaled(count(r"\$[^$]+\$"), 8), scaled(count(r"\d+"), 16), F.when(F.length(text) > 0, 0.5).otherwise(-0.5))
    return metadata.where("problem_key is not null").groupBy("problem_key").agg(F.min_by(made, F.xxhash64(text)).alias("item"))


def items(voted: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """A row per problem: its votes as one list and its features as one array.

    The list has at most one entry per grader, so its length is bounded by the number of graders.
    ``features`` (problem_key, item array) adds features of the item itself; items without count as 0 there.
    """
    each = F.struct("grader_id", *(vote_of(m).alias(m) for m in METRICS))
    within = lambda c: F.when(F.col(c).between(LOWEST, HIGHEST), F.col(c) / 100.0 - 0.5)
    made = voted.groupBy("problem_key").agg(
        F.collect_list(each).alias("votes"),
        F.array(F.lit(1.0), F.coalesce(F.avg(within("solution_completeness")), F.lit(0.0)), F.coalesce(F.avg(within("test_case_quality")), F.lit(0.0)), F.coalesce(F.avg("commented"), F.lit(0.0))).alias("features"),
    )
    if features is None:
        return made
    width = features.select(F.coalesce(F.max(F.size("item")), F.lit(0))).first()[0]
    joined = made.join(features.select("problem_key", "item"), "problem_key", "left")
    return joined.select("problem_key", "votes", F.concat("features", F.coalesce("item", F.array_repeat(F.lit(0.0), width))).alias("features"))


@dataclass
class Model:
    """Per metric: log odds of each vote given the truth, for each grader, and the classifier."""

    graders: list[str]
    right_pass: np.ndarray  # metric x grader: P(vote pass | truth pass)
    right_fail: np.ndarray  # metric x grader: P(vote fail | truth fail)
    weights: np.ndarray  # metric x feature, for "pass"
    rounds: int = 0
    objective: list[float] = field(default_factory=list)  # penalised log likelihood before each round but the first
    seen: np.ndarray = field(default_factory=lambda: np.zeros(0))


def unpack(batch: pa.RecordBatch, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, graders, votes (metric x n, -1: none) of a batch, and the features."""
    votes = batch.column("votes")
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(votes).to_numpy(zero_copy_only=False).astype(np.int64))
    flat = pc.list_flatten(votes)
    named = flat.field("grader_id").dictionary_encode()
    grader = np.array([index[g] for g in named.dictionary.to_pylist()], np.int64)[named.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
    vote = np.array([pc.fill_null(flat.field(m), -1).to_numpy(zero_copy_only=False) for m in METRICS], np.int64).reshape(len(METRICS), len(flat))
    features = pc.list_flatten(batch.column("features")).to_numpy(zero_copy_only=False).astype(float)
    return row, grader, vote, features.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))


def sides(model: Model, row: np.ndarray, grader: np.ndarray, vote: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(pass) of each item by votes and classifier, the number of its votes, per metric, and the batch's log likelihood with labels summed out."""
    out, counted, total, n = [], [], 0.0, len(features)
    for m in range(len(METRICS)):
        v, z = vote[m], features @ model.weights[m]
        # log P(vote | truth) by what was said: no vote, fail, pass
        if_pass = np.stack([np.zeros(len(model.graders)), np.log1p(-model.right_pass[m]), np.log(model.right_pass[m])])[v + 1, grader]
        if_fail = np.stack([np.zeros(len(model.graders)), np.log(model.right_fail[m]), np.log1p(-model.right_fail[m])])[v + 1, grader]
        yes, no = np.bincount(row, if_pass, n), np.bincount(row, if_fail, n)
        out.append(1 / (1 + np.exp(-np.clip(z + yes - no, -500, 500))))
        counted.append(np.bincount(row, v >= 0, n))
        total += float(np.logaddexp(yes - np.logaddexp(0, -z), no - np.logaddexp(0, z)).sum())
    return np.array(out), np.array(counted), total


def penalty(model: Model, ridge: np.ndarray) -> float:
    """What the pseudo-counts and the ridge add to the log likelihood."""
    rights = np.concatenate([model.right_pass.ravel(), model.right_fail.ravel()])
    return float(SMOOTH[0] * np.log(rights).sum() + SMOOTH[1] * np.log1p(-rights).sum() - 0.5 * sum(w @ ridge @ w for w in model.weights))


def majorities(row: np.ndarray, vote: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first guess: the share of pass votes, drawn towards one half."""
    out, counted = [], []
    for v in vote:
        have = np.bincount(row, v >= 0, n)
        out.append((np.bincount(row, v == 1, n) + 0.5) / (have + 1.0))
        counted.append(have)
    return np.array(out), np.array(counted)


def fit(items_df: DataFrame, graders: list[str]) -> Model:
    """EM over ``items_df`` (checkpointed items); one narrow pass a round.

    The classifier takes one Newton step a round on the expected labels (generalised EM).
    """
    index = {g: k for k, g in enumerate(graders)}
    first = items_df.select(F.size("features")).first()
    n, d, k = len(METRICS), first[0] if first else len(FEATURES), len(graders)
    model: Model | None = None
    weights = np.zeros((n, d))

    def sums(current: Model | None, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        def run(batches):
            counts, gradient, hessian, evidence = np.zeros((n, k, 4)), np.zeros((n, d)), np.zeros((n, d, d)), 0.0
            for batch in batches:
                if not batch.num_rows:
                    continue
                row, grader, vote, features = unpack(batch, index)
                if current is None:
                    p, have = majorities(row, vote, len(features))
                else:
                    p, have, likely = sides(current, row, grader, vote, features)
                    evidence += likely
                for m in range(n):
                    ok = have[m] > 0
                    for truth, q in ((1, p[m]), (0, 1 - p[m])):
                        for said in (1, 0):
                            at = vote[m] == said
                            counts[m, :, 2 * truth + said] += np.bincount(grader[at], q[row[at]], k)
                    prior = 1 / (1 + np.exp(-features[ok] @ w[m]))
                    gradient[m] += features[ok].T @ (p[m][ok] - prior)
                    hessian[m] += (features[ok] * (prior * (1 - prior))[:, None]).T @ features[ok]
            part = np.concatenate([counts.ravel(), gradient.ravel(), hessian.ravel(), [evidence]])
            yield pa.RecordBatch.from_arrays([pa.array([part.tolist()], pa.list_(pa.float64()))], names=["part"])

        size = n * k * 4 + n * d + n * d * d + 1
        parts = items_df.select("votes", "features").mapInArrow(run, "part array<double>")
        added = parts.select(F.posexplode("part").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(size)
        for r in added:
            flat[r["at"]] = r["x"]
        a, b = n * k * 4, n * k * 4 + n * d
        return flat[:a].reshape(n, k, 4), flat[a:b].reshape(n, d), flat[b:-1].reshape(n, d, d), flat[-1]

    ridge, objective = np.diag([1e-3] + [RIDGE] * (d - 1)), []
    for step in range(ROUNDS):
        counts, gradient, hessian, evidence = sums(model, weights)
        if model is not None:
            objective.append(evidence + penalty(model, ridge))
        right_pass = (counts[:, :, 3] + SMOOTH[0]) / (counts[:, :, 3] + counts[:, :, 2] + sum(SMOOTH))
        right_fail = (counts[:, :, 0] + SMOOTH[0]) / (counts[:, :, 0] + counts[:, :, 1] + sum(SMOOTH))
        weights = weights + np.stack([np.linalg.solve(hessian[m] + ridge, gradient[m] - ridge @ weights[m]) for m in range(n)])
        weights = np.clip(weights, -8, 8)
        moved = np.inf if model is None else max(np.abs(right_pass - model.right_pass).max(initial=0), np.abs(right_fail - model.right_fail).max(initial=0))
        model = Model(graders, right_pass, right_fail, weights, step + 1, objective, counts.sum(axis=2))
        if moved < TOLERANCE:
            break
    return model


def consensus(grades: DataFrame, features: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(consensus, graders); ``features`` (problem_key, item) are features of the items themselves.

    consensus: problem_key, metric, consensus ("pass" / "fail"), p_fail, n_votes, agreement
    (share of pairs of votes that agree; null for one vote). An item without votes on a
    metric has no row for it; p_fail of exactly one half is a "pass".
    graders: grader_id, metric, n_votes, pass_rate_right, fail_rate_right, reliability
    (mean of both rights, minus one half, doubled: 1 perfect, 0 noise, below 0 contrary).
    Empty grades give two empty frames.
    """
    spark = grades.sparkSession
    ready = cut(items(votes(grades), features))
    # one row per annotator: bounded by their number, not by the items
    graders = sorted(r[0] for r in ready.select(F.explode("votes.grader_id")).distinct().collect())
    model = fit(ready, graders)
    index = {g: k for k, g in enumerate(graders)}

    def decide(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, grader, vote, features = unpack(batch, index)
            p, have, _ = sides(model, row, grader, vote, features)
            for m, metric in enumerate(METRICS):
                ok = np.flatnonzero(have[m] > 0)
                n = have[m][ok].astype(float)
                yes = np.bincount(row, vote[m] == 1, batch.num_rows)[ok]
                agree = (yes * (yes - 1) + (n - yes) * (n - yes - 1)) / np.maximum(n * (n - 1), 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("problem_key").take(pa.array(ok)), pa.array([metric] * len(ok), pa.string()), pa.array(np.where(p[m][ok] < 0.5, "fail", "pass").tolist(), pa.string()), pa.array(1 - p[m][ok]), pa.array(n.astype(np.int64)), pa.array(agree, mask=n < 2)],
                    names=["problem_key", "metric", "consensus", "p_fail", "n_votes", "agreement"],
                )

    decided = ready.mapInArrow(decide, "problem_key bigint, metric string, consensus string, p_fail double, n_votes bigint, agreement double")
    rated = [
        (g, metric, int(round(model.seen[m, k])), float(model.right_pass[m, k]), float(model.right_fail[m, k]), float(model.right_pass[m, k] + model.right_fail[m, k] - 1))
        for k, g in enumerate(graders)
        for m, metric in enumerate(METRICS)
    ]
    return decided, spark.createDataFrame(rated, "grader_id string, metric string, n_votes bigint, pass_rate_right double, fail_rate_right double, reliability double")
