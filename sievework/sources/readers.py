"""Readers of problem documents, topics, seed pairs, ledgers and configurations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievework.functions.text import pair_hash, repaired_text

#: Documents as they lie in files; what has more than one shape stays JSON text.
DOCUMENT = (
    "problem_id string, problem_metadata map<string,string>, problem_details struct<`Problem Statement`:string,Solution:string,`Answer Requirements`:string,Answer:string,Code:string,test:string>,"
    "original_seed struct<seed_type:string,arxiv_id:string,seed_data:struct<problem:string,solution:string,example:string>>,"
    "quality_gradings map<string,array<struct<index:int,timestamp:string,problem_quality:int,problem_quality_comment:string,solution_completeness:int,solution_completeness_comment:string,"
    "solution_quality:int,solution_quality_comment:string,test_case_quality:int,test_case_quality_comment:string,seed_correspondence:int,output_seed_correspondence:int>>>,"
    "quality struct<index:int,timestamp:string,problem_quality:int,problem_quality_comment:string,solution_completeness:int,solution_completeness_comment:string,"
    "solution_quality:int,solution_quality_comment:string,test_case_quality:int,test_case_quality_comment:string,seed_correspondence:int,output_seed_correspondence:int>,"
    "model_solutions array<struct<model:string,attempts:array<struct<timestamp:string,prompt_type:string,detailed_solution:string,verifier_result:string>>>>,"
    "indep_solver_results map<string,struct<passed:boolean,attempts_needed:int,max_k:int,prompt_type:string,timestamp:string>>"
)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def documents(spark: SparkSession, folder: str, recursive: bool = False, pattern: str = "p*.json", repair: bool = True, ordered: bool = False, required: bool = False) -> DataFrame:
    """(file_path, status_dir, fields of DOCUMENT) of all problem files.

    ``ordered`` sorts by file name (p1, p10, p2); with ``required`` a folder without documents is an error.

    Files that hold no problem (lists, broken JSON, no problem_id) are left out; text after
    a complete document is cut off. ``status_dir`` is the sub-folder a file lies in.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    files = (reader.option("recursiveFileLookup", True) if recursive else reader).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")
    text = repaired_text("value") if repair else F.col("value")
    parsed = files.select("file_path", F.from_json(text, DOCUMENT).alias("d"))
    here = folder.rstrip("/").rsplit("/", 1)[-1]
    kept = parsed.where(F.col("d.problem_id").isNotNull())
    out = kept.select("file_path", F.when(parent_name(F.col("file_path")) != here, parent_name(F.col("file_path"))).alias("status_dir"), "d.*")
    if required and out.isEmpty():
        raise FileNotFoundError(f"no problem documents in {folder}")
    return out.orderBy(file_name(F.col("file_path"))) if ordered else out


@F.pandas_udf(StructType([StructField("error", StringType()), StructField("line", IntegerType()), StructField("around", StringType())]))
def json_error(batches: pd.Series) -> pd.DataFrame:
    """What is wrong with JSON text, the line it is in, and two lines before and after; nulls for text that is well formed."""
    rows = []
    for text in batches:
        try:
            json.loads(text or "")
            rows.append((None, None, None))
        except (ValueError, RecursionError) as e:
            line = getattr(e, "lineno", 1)
            lines = (text or "").split("\n")
            rows.append((str(e)[:300], line, "\n".join(lines[max(0, line - 3) : line + 2])))
    return pd.DataFrame(rows, columns=["error", "line", "around"])


def errors(spark: SparkSession, folder: str, pattern: str = "p*.json") -> DataFrame:
    """(file_path, error, line, around) of files that are no well-formed JSON, those with text after their end too."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return files.select("file_path", json_error("value").alias("e")).select("file_path", "e.*").where("error is not null")


def broken_documents(spark: SparkSession, folder: str, pattern: str = "p*.json") -> DataFrame:
    """Paths of problem files that hold no readable document."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return files.where(F.from_json(repaired_text("value"), "problem_id string")["problem_id"].isNull()).select("file_path")


def topics(spark: SparkSession, path: str) -> DataFrame:
    """level, level_ord, subcategory, topic_ord (in the level), id, topic, description; document order."""

    def run(frames):
        for frame in frames:
            rows = []
            for text in frame["value"]:
                try:
                    levels = json.loads(text)
                except ValueError:
                    levels = {}  # a file that cannot be read has no topics
                for level_ord, (level, groups) in enumerate(levels.items() if isinstance(levels, dict) else ()):
                    flat = [(group, entry) for group, entries in groups.items() for entry in entries]
                    rows += [(level, level_ord, group, k, e.get("id"), e.get("topic"), e.get("description")) for k, (group, e) in enumerate(flat)]
            yield pd.DataFrame(rows, columns=["level", "level_ord", "subcategory", "topic_ord", "id", "topic", "description"])

    return spark.read.text(path, wholetext=True).mapInPandas(run, "level string, level_ord int, subcategory string, topic_ord int, id string, topic string, description string")


def seed_directories(spark: SparkSession, base: str) -> list[str]:
    """Sub-folders of seeds, by name: those with a seed file, and those whose name has a digit and a dot. A listing of folders, not of data."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(base)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        held = any(files.exists(hadoop.Path(entry.getPath(), f)) for f in ("matched_pairs.yaml", "example_pairs.yaml")) if entry.isDirectory() else False
        if entry.isDirectory() and (held or ("." in name and any(c.isdigit() for c in name))):
            out.append(name)
    return sorted(out)


def seed_pairs(spark: SparkSession, base: str, examples: int | None = None, matched: int | None = None) -> DataFrame:
    """arxiv_id (the folder's name), seed_type, pos, problem, solution, pair_hash of all YAML seed files under ``base``.

    ``examples`` and ``matched`` limit the pairs of each kind of a folder to its first.

    Null documents are dropped, mappings stand for their content, files that can't be read give none.
    """

    def words(value: Any) -> str:
        if isinstance(value, dict):
            value = value.get("content")
        return value if isinstance(value, str) else ""

    def run(frames):
        import yaml

        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    docs = list(yaml.safe_load_all(bytes(content).decode()))
                except (yaml.YAMLError, UnicodeDecodeError):
                    docs = []
                kind = "example" if path.endswith("example_pairs.yaml") else "matched"
                rows += [(path.split("/")[-2], kind, k, words(d.get("problem")), words(d.get("solution"))) for k, d in enumerate(d for d in docs if isinstance(d, dict))]
            yield pd.DataFrame(rows, columns=["arxiv_id", "seed_type", "pos", "problem", "solution"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "{matched,example}_pairs.yaml").load(base).select("path", "content")
    pairs = files.mapInPandas(run, "arxiv_id string, seed_type string, pos int, problem string, solution string").withColumn("pair_hash", pair_hash(F.col("arxiv_id"), F.col("problem")))
    for kind, most in (("example", examples), ("matched", matched)):
        if most is not None:
            pairs = pairs.where((F.col("seed_type") != kind) | (F.col("pos") < most))
    return pairs


def processed_hashes(docs: DataFrame) -> DataFrame:
    """Seed pair hashes that documents carry already."""
    return docs.select(F.try_element_at("problem_metadata", F.lit("Seed Pair Hash")).alias("pair_hash")).where("pair_hash is not null").distinct()


def assignment(spark: SparkSession, path: str) -> DataFrame:
    """(topic_id, problem_no) of a ledger file; entries that are no numbers are left out."""
    ledger = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("topic_id", "n"))
    return ledger.select("topic_id", F.explode("n").alias("n")).select("topic_id", F.col("n").try_cast("int").alias("problem_no")).where("problem_no is not null")


def greatest_index(paths: DataFrame, path: str = "file_path") -> DataFrame:
    """The greatest N of file names pN.json, 0 without any."""
    return paths.agg(F.coalesce(F.max(F.regexp_extract(path, r"p(\d+)\.json$", 1).try_cast("bigint")), F.lit(0)).cast("bigint").alias("max_index"))


def completed_by_topic(docs: DataFrame) -> DataFrame:
    """topic_id and the sorted numbers of its finished problems."""
    number = F.regexp_extract("problem_id", r"(\d+)$", 1).try_cast("int")
    return docs.select(F.try_element_at("problem_metadata", F.lit("Topic Entry ID")).alias("topic_id"), number.alias("n")).where("topic_id is not null and n is not null").groupBy("topic_id").agg(F.sort_array(F.collect_set("n")).alias("problems"))


def config(path: str) -> dict[str, Any]:
    """A YAML or JSON configuration, read on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def attempts(docs: DataFrame) -> DataFrame:
    """problem_id, level, topic_id, model, model_ord, attempt_ord, and the attempt's fields."""
    meta = lambda key: F.try_element_at("problem_metadata", F.lit(key))
    models = docs.select("problem_id", meta("Difficulty level").alias("level"), meta("Topic Entry ID").alias("topic_id"), F.posexplode("model_solutions").alias("model_ord", "m"))
    return models.select("problem_id", "level", "topic_id", "model_ord", F.col("m.model").alias("model"), F.posexplode("m.attempts").alias("attempt_ord", "a")).select("problem_id", "level", "topic_id", "model_ord", "model", "attempt_ord", "a.*")


def grades(docs: DataFrame, fields: Sequence[str] = ("index", "problem_quality", "solution_completeness", "solution_quality", "test_case_quality")) -> DataFrame:
    """problem_id, model_id, model_ord (document order), pos, and the scores of every grade."""
    entries = docs.select("problem_id", F.posexplode(F.map_entries("quality_gradings")).alias("model_ord", "e"))
    return entries.select("problem_id", "model_ord", F.col("e.key").alias("model_id"), F.posexplode("e.value").alias("pos", "g")).select("problem_id", "model_ord", "model_id", "pos", *(F.col(f"g.{f}").alias(f) for f in fields))
