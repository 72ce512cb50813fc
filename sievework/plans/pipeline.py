"""The stages as plans from DataFrame to DataFrame: generate, grade, solve, evaluate. Every stage can be asked for its plan only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import allocate, predicates, verdicts
from sievework.operators import grades as graded
from sievework.plans import cases, prompts
from sievework.plans.providers import Provider, Stub, call
from sievework.session import cut
from sievework.sources.readers import config as config_file


@dataclass
class Config:
    """What a run needs; a driver-side object, not a table."""

    topic_name: str = "topic"
    num_problems: int = 5
    level_split: dict[str, float] = field(default_factory=dict)
    tasks: tuple[int, int] = (1, 1)
    dependent: bool = False
    generator: str = "stub"
    graders: tuple[str, ...] = ("test-model",)
    qc_runs: int = 1
    threshold: float = 0.8
    tries: int = 3
    solver: str = "stub"
    max_k: int = 3
    provider: Provider = field(default_factory=Stub)
    dry_run: bool = False


#: Names of a configuration file -> fields of Config.
SETTINGS = {"topic_name": "topic_name", "num_problems": "num_problems", "level_split": "level_split", "model": "generator", "qc_runs": "qc_runs", "qc_threshold": "threshold", "solver_model": "solver", "max_k": "max_k", "dry_run": "dry_run"}


def configured(path: str, **more: object) -> Config:
    """A Config from a YAML or JSON file; what it does not name keeps its default, ``more`` wins over both."""
    read = config_file(path)
    known = {field_: read[name] for name, field_ in SETTINGS.items() if read.get(name) is not None}
    task = read.get("task_config") or {}
    known["tasks"] = (int(task.get("tasks_min", 1)), int(task.get("tasks_max", task.get("tasks_min", 1))))
    known["dependent"] = bool(task.get("tasks_dependent", False))
    return Config(**{**known, **more})


def listing(earlier: Column) -> Column:
    """What a prompt says of the problems its topic has."""
    return F.concat(F.lit("\n\nPreviously generated problems in this topic:\n"), T.numbered_list(earlier), F.lit("\n\nMake a problem with tasks that differ from those listed; some similarity is acceptable, a copy is not."))


def generation_plan(topics: DataFrame, config: Config, start: int = 1, previous: DataFrame | None = None) -> DataFrame:
    """(level, topic_id, problem_no, prompt): what would be generated.

    ``previous`` (id, position, description): each prompt lists all earlier descriptions of its topic.
    """
    spark = topics.sparkSession
    order = {r["level"]: r["level_ord"] for r in topics.select("level", "level_ord").distinct().collect()}
    unknown = set(config.level_split) - set(order)
    if unknown:
        raise ValueError(f"levels without topics: {sorted(unknown)}")
    split = config.level_split or dict.fromkeys(order, 1.0)
    levels = spark.createDataFrame([(level, order[level], float(r)) for level, r in split.items()], "level string, level_ord int, ratio double")
    counts = allocate.level_counts(levels, config.num_problems)
    work = allocate.distribute(counts, topics, "level", "level_ord", "id", "topic_ord", start)
    template = "Topic: {{TITLE}}\n{{DESCRIPTION}}\n" + T.task_instructions(*config.tasks, config.dependent)
    made = T.prompt(template, TITLE=F.col("topic"), DESCRIPTION=F.col("description"))
    about = topics.select("id", "topic", "description")
    if previous is not None:
        lists = allocate.context_lists(previous.select("id", "position", "description"), "id", "description")
        about = about.join(lists, "id", "left")
        made = F.concat(made, F.coalesce(listing(F.col("previous")), F.lit("")))
    return work.join(about, "id").select("level", F.col("id").alias("topic_id"), "problem_no", made.alias("prompt"))


def parsed(said: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the sections of each answer; the code is the last fence, else the section's first part."""
    parts = T.sections(F.col("response"))
    section = lambda name: F.try_element_at(parts, F.lit(name))
    code = F.coalesce(T.last_code(F.col("response")), T.first_subsection(section("Code")))
    return said.select(*keys, section("Problem Statement").alias("statement"), section("Problem Description").alias("description"), section("Answer Requirements").alias("requirements"), section("Solution").alias("solution"), section("Answer").alias("answer"), code.alias("code"), "error")


def generate(topics: DataFrame, config: Config, start: int = 1, previous: DataFrame | None = None) -> DataFrame:
    """problem_id, level, topic_id and the sections of each answer; rows whose call failed keep their error."""
    plan = generation_plan(topics, config, start, previous)
    if config.dry_run:
        return plan
    said = cut(call(plan.withColumn("model", F.lit(config.generator)), config.provider, "prompt", "model"))
    return parsed(said.withColumn("problem_id", F.concat(F.lit("p"), "problem_no")), ["problem_id", "level", "topic_id"])


def generate_in_turns(topics: DataFrame, config: Config, start: int = 1) -> DataFrame:
    """As ``generate``, but each problem's prompt lists all earlier problems of its topic, those of the same run too.

    The r-th problems of all topics are made at once, then the next: as many rounds as a topic has problems.
    """
    plan = cut(generation_plan(topics, config, start).withColumn("turn", F.row_number().over(Window.partitionBy("topic_id").orderBy("problem_no"))))
    made: DataFrame | None = None
    for turn in range(1, (plan.agg(F.max("turn")).first()[0] or 0) + 1):
        due = plan.where(F.col("turn") == turn)
        if made is not None:
            seen = made.where("statement is not null").groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("problem_no", "statement"))).alias("_l"))
            due = due.join(seen, "topic_id", "left").withColumn("prompt", F.concat("prompt", F.coalesce(listing(F.col("_l")["statement"]), F.lit("")))).drop("_l")
        said = call(due.withColumn("model", F.lit(config.generator)), config.provider, "prompt", "model")
        new = cut(parsed(said.withColumn("problem_id", F.concat(F.lit("p"), "problem_no")), ["problem_id", "problem_no", "level", "topic_id"]))
        made = new if made is None else cut(made.unionByName(new))
    return made if made is not None else parsed(plan.withColumn("problem_id", F.lit("")).withColumn("response", F.lit("")).withColumn("error", F.lit("")), ["problem_id", "problem_no", "level", "topic_id"])


def seed_work(pairs: DataFrame, done: DataFrame, config: Config, start: int = 1) -> DataFrame:
    """Seed pairs to adapt: valid ones that no document carries, the first ``num_problems``, numbered. ``pairs``: arxiv_id, seed_type, pos, problem, solution, pair_hash."""
    order = ["arxiv_id", "seed_type", "pos"]
    valid = allocate.remaining(predicates.valid_pairs(pairs), done, "pair_hash")
    # of pairs delivered again the first counts
    rest = [c for c in valid.columns if c != "pair_hash"]
    left = valid.groupBy("pair_hash").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_p")).select("pair_hash", "_p.*")
    # the limit is the feature: as many problems as are asked for, by number so that no task orders them all
    return allocate.numbered(left, order, "problem_no", start).where(F.col("problem_no") < start + config.num_problems)


def generate_adapted(pairs: DataFrame, done: DataFrame, config: Config, system: str = "", start: int = 1) -> DataFrame:
    """problem_id, the seed, and the sections of the problem made from it."""
    work = seed_work(pairs, done, config, start)
    asked = work.withColumn("prompt", prompts.adapted(F.lit(system), F.col("seed_type"), prompts.seed_text(F.col("problem"), F.col("solution"))))
    if config.dry_run:
        return asked.select("problem_no", "arxiv_id", "seed_type", "pair_hash", "prompt")
    said = cut(call(asked.withColumn("model", F.lit(config.generator)), config.provider, "prompt", "model"))
    seed = F.struct("seed_type", "arxiv_id", F.struct("problem", "solution").alias("seed_data")).alias("original_seed")
    keyed = said.withColumn("problem_id", F.concat(F.lit("p"), "problem_no")).select("problem_id", "pair_hash", seed, "response", "error")
    return parsed(keyed, ["problem_id", "pair_hash", "original_seed"])


def as_documents(problems: DataFrame, config: Config, today: Column | None = None) -> DataFrame:
    """Problems as documents: problem_id, problem_metadata, problem_details and, where there is one, original_seed."""
    has = set(problems.columns)
    meta = {"Domain": F.lit(config.topic_name), "Problem Origin": F.lit(config.generator), "Date Added": (today if today is not None else F.current_date()).cast("string")}
    meta |= {name: F.col(c) for name, c in (("Topic Entry ID", "topic_id"), ("Difficulty level", "level"), ("Problem Description", "description"), ("Seed Pair Hash", "pair_hash")) if c in has}
    metadata = F.map_filter(F.create_map(*(x for name, value in meta.items() for x in (F.lit(name), value.cast("string")))), lambda k, v: v.isNotNull())
    details = F.struct(*(F.col(c).alias(name) for name, c in (("Problem Statement", "statement"), ("Solution", "solution"), ("Answer Requirements", "requirements"), ("Answer", "answer"))), T.wrap_code(F.col("code")).alias("Code"))
    seed = ["original_seed"] if "original_seed" in has else []
    return problems.select("problem_id", metadata.alias("problem_metadata"), details.alias("problem_details"), *seed)


def quality(problems: DataFrame, grades: DataFrame, config: Config) -> DataFrame:
    """New grades for problems that have fewer than qc_runs by a grader: problem_id, grader_id, run_index, scores.

    A call whose answer holds no score is made again, as often as ``tries`` of the configuration says.
    """
    graders = F.explode(F.array(*(F.lit(g) for g in config.graders)))
    optional = {c: F.col(c) if c in problems.columns else F.lit(None).cast("string") for c in ("answer", "code", "seed")}
    due = problems.select("problem_id", "statement", "solution", *(v.alias(k) for k, v in optional.items()), graders.alias("grader_id"))
    have = grades.groupBy("problem_id", "grader_id").agg(F.count(F.lit(1)).alias("n"), F.max("run_index").alias("last"))
    need = due.join(have, ["problem_id", "grader_id"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < config.qc_runs)
    runs = need.withColumn("step", F.explode(F.sequence(F.lit(1), (F.lit(config.qc_runs) - F.col("n")).cast("int")))).withColumn("run_index", (F.coalesce("last", F.lit(-1)) + F.col("step")).cast("int"))
    prompt = prompts.grading(F.col("statement"), F.col("solution"), F.col("answer"), F.col("code"), F.lit("none"), F.col("seed"))
    asked = runs.select("problem_id", "grader_id", "run_index", prompt.alias("prompt"))
    if config.dry_run:
        return asked
    scores = F.from_json(T.object_text("response"), ", ".join(f"{m} int" for m in (*prompts.RUBRIC, *prompts.SEED_RUBRIC)))
    out: DataFrame | None = None
    for _ in range(config.tries):
        said = call(asked, config.provider, "prompt", "grader_id")
        got = cut(said.select("problem_id", "grader_id", "run_index", "prompt", scores.alias("s"), "error").select("problem_id", "grader_id", "run_index", "prompt", "s.*", "error"))
        good = got.where(F.coalesce(*prompts.RUBRIC).isNotNull())
        out = good if out is None else out.unionByName(good)
        empty = got.where(F.coalesce(*prompts.RUBRIC).isNull())
        asked = empty.select("problem_id", "grader_id", "run_index", "prompt")
        if asked.isEmpty():
            break
    else:
        out = out.unionByName(empty)
    return out.drop("prompt")


def keep_graded(problems: DataFrame, grades: DataFrame, config: Config) -> DataFrame:
    """Problems with status ok where every grader's latest grade passes, else qc_failed; without a grade they fail."""
    last = graded.latest(grades, ["problem_id", "grader_id"], tie=())
    ok = last.groupBy("problem_id").agg(F.min(graded.passes(("problem_quality", "solution_completeness", "solution_quality"), config.threshold).cast("int")).alias("_ok"))
    return predicates.with_status(problems.join(ok, "problem_id", "left"), F.col("_ok") == 1, "qc_failed").drop("_ok")


def keep_solved(problems: DataFrame, results: DataFrame) -> DataFrame:
    """Problems whose status was ok and that no result passes become solver_failed."""
    won = results.groupBy("problem_id").agg(F.max(F.coalesce("passed", F.lit(False)).cast("int")).alias("_won"))
    return predicates.with_status(problems.join(won, "problem_id", "left"), F.col("_won") == 1, "solver_failed").drop("_won")


def solve(problems: DataFrame, config: Config, results: DataFrame | None = None) -> DataFrame:
    """problem_id, passed, attempts_needed: a new attempt for every problem still unsolved, k times at most.

    ``problems``: problem_id, statement, code, cases. Results of earlier runs that passed or used up k are skipped.
    """
    todo = problems
    if results is not None:
        done = results.where(~predicates.to_resume(F.col("passed"), F.col("attempts_needed"), config.max_k))
        todo = problems.join(done.select("problem_id"), "problem_id", "left_anti")
    if config.dry_run:
        return todo.select("problem_id")
    ends: DataFrame | None = None
    open_ = cut(cases.standard_runs(todo.select("problem_id", "statement", "code", F.col("cases").cast(cases.CASES).alias("cases")), "code", "cases", "ran"))
    for k in range(1, config.max_k + 1):
        asked = open_.withColumn("prompt", prompts.solving(F.col("statement"), F.lit(None).cast("string"), F.col("code"), F.lit(k))).withColumn("model", F.lit(config.solver))
        said = call(asked.select("problem_id", "code", "cases", "ran", "prompt", "model"), config.provider, "prompt", "model").withColumn("attempt_code", T.last_code(F.col("response")))
        judged = cut(cases.grade(said, ["problem_id"], "code", "attempt_code", "cases", ran_col="ran"))
        solved = judged.where("verified = 1").select("problem_id", F.lit(True).alias("passed"), F.lit(k).alias("attempts_needed"))
        ends = solved if ends is None else ends.unionByName(solved)
        open_ = open_.join(solved.select("problem_id"), "problem_id", "left_anti")
        if open_.isEmpty():
            break
    failed = open_.select("problem_id", F.lit(False).alias("passed"), F.lit(config.max_k).alias("attempts_needed"))
    return failed if ends is None else ends.unionByName(failed)


def ready_cases(problems: DataFrame) -> DataFrame:
    """Problems that have a function, with test cases made by rule."""
    made = cases.synthesize(problems, "problem_id", "code").groupBy("problem_id").agg(F.sort_array(F.collect_list(F.struct("case_id", "inputs"))).alias("cases"))
    return problems.join(made, "problem_id")


def finish(problems: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Grade, filter, solve what passed, filter again; each stage is written before the next reads it."""
    spark = problems.sparkSession
    none = spark.createDataFrame([], "problem_id string, grader_id string, run_index int")
    grades = cut(quality(problems, none, config))
    checked = cut(keep_graded(problems, grades, config))
    ready = cut(ready_cases(checked.where("status = 'ok'")))
    results = cut(solve(ready, config))
    return {"problems": keep_solved(checked, results), "grades": grades, "results": results}


def run(topics: DataFrame, config: Config, previous: DataFrame | None = None) -> dict[str, DataFrame]:
    """All stages from topics: problems (with status), grades, solver results. Only problems that pass the grades are solved."""
    problems = generate(topics, config, previous=previous)
    return {"plan": problems} if config.dry_run else finish(cut(problems), config)


def run_adapted(pairs: DataFrame, done: DataFrame, config: Config, system: str = "") -> dict[str, DataFrame]:
    """All stages from seed pairs; grading is shown the seed."""
    problems = generate_adapted(pairs, done, config, system)
    if config.dry_run:
        return {"plan": problems}
    seed = prompts.seed_text(F.col("original_seed.seed_data.problem"), F.col("original_seed.seed_data.solution"))
    return finish(cut(problems.withColumn("seed", seed)), config)


def top_up(problems: DataFrame, attempts: DataFrame, config: Config) -> DataFrame:
    """(problem_id, model, attempt_no, prompt): attempts a model still owes, up to max_k each; nothing for those that have them."""
    have = attempts.groupBy("problem_id", "model").agg(F.count(F.lit(1)).alias("n"), F.max("attempt_no").alias("last"))
    due = problems.withColumn("model", F.lit(config.solver)).join(have, ["problem_id", "model"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < config.max_k)
    each = due.withColumn("step", F.explode(F.sequence(F.lit(1), (F.lit(config.max_k) - F.col("n")).cast("int")))).withColumn("attempt_no", (F.coalesce("last", F.lit(0)) + F.col("step")).cast("int"))
    return each.withColumn("prompt", prompts.solving(F.col("statement"), F.lit(None).cast("string"), F.col("code"), F.col("attempt_no")))


def evaluate(problems: DataFrame, attempts: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(attempts with verdicts, metrics per model): owed attempts are made, all new ones graded, then summed up.

    ``problems``: problem_id, statement, code, cases; ``attempts``: problem_id, model, attempt_no, verified.
    """
    said = call(top_up(problems, attempts, config).select("problem_id", "model", "attempt_no", "code", "cases", "prompt"), config.provider, "prompt", "model")
    tried = cut(said.where("response <> ''").withColumn("attempt_code", T.last_code(F.col("response"))))
    new = cases.grade(tried, ["problem_id", "model", "attempt_no"], "code", "attempt_code", "cases", together=("problem_id", "model")).select("problem_id", "model", "attempt_no", "verified")
    every = cut(attempts.select("problem_id", "model", "attempt_no", "verified").unionByName(new))
    rates = verdicts.verification_metrics(every)
    best = verdicts.best_of_n(every.where(F.col("attempt_no") <= config.max_k), "problem_id")
    return every, rates.join(best, "model", "left")
