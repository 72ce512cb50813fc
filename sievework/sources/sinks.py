"""Sinks: documents by status, one file per document, ledgers, logs, splits."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_documents(docs: DataFrame, path: str, status: str = "status", mode: str = "overwrite") -> None:
    """JSON documents in a folder per status; Spark's commit makes a folder whole or not there."""
    docs.write.mode(mode).partitionBy(status).option("ignoreNullFields", True).json(path)


def export_files(docs: DataFrame, folder: str, name: str = "problem_id") -> None:
    """One indented file per document on a shared file system, written where the rows are, each by rename."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for key, text in zip(frame["k"], frame["j"]):
                target = os.path.join(folder, f"{key}.json")
                with open(f"{target}.tmp", "w", encoding="utf-8") as f:
                    json.dump(json.loads(text), f, indent=2, ensure_ascii=False)
                os.replace(f"{target}.tmp", target)
            yield pd.DataFrame({"n": [len(frame)]})

    os.makedirs(folder, exist_ok=True)
    body = F.to_json(F.struct(*(c for c in docs.columns if c not in ("status", "status_dir", "file_path"))), {"ignoreNullFields": "true"})
    docs.select(F.col(name).alias("k"), body.alias("j")).mapInPandas(run, "n bigint").agg(F.sum("n")).collect()


def export_texts(texts: DataFrame, folder: str, name: str, text: str, suffix: str = ".json") -> None:
    """One file per row as its text stands, in sub-folders where names have them; written where the rows are, each by rename."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for key, body in zip(frame["k"], frame["t"]):
                target = os.path.join(folder, f"{key}{suffix}")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(f"{target}.tmp", "w", encoding="utf-8") as f:
                    f.write(body)
                os.replace(f"{target}.tmp", target)
            yield pd.DataFrame({"n": [len(frame)]})

    os.makedirs(folder, exist_ok=True)
    texts.select(F.col(name).alias("k"), F.col(text).alias("t")).mapInPandas(run, "n bigint").agg(F.sum("n")).collect()


def write_checked(df: DataFrame, path: str) -> int:
    """Replaces a table after reading the new one back: its rows and columns must be those written. Returns the rows."""
    spark = df.sparkSession
    fresh = path + ".new"
    df.write.mode("overwrite").parquet(fresh)
    back = spark.read.parquet(fresh)
    rows = back.count()
    if [f.name for f in back.schema] != df.columns or rows != df.count():
        raise OSError(f"{fresh} does not hold what was written")
    swap(spark, fresh, path)
    return rows


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a new folder in the place of another by renames."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, new, old = hadoop.Path(path), hadoop.Path(fresh), hadoop.Path(path + ".old")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(old, True)
    if files.exists(place):
        files.rename(place, old)
    files.rename(new, place)
    files.delete(old, True)


def copy_config(source: str, folder: str) -> str:
    """A configuration file copied into its data set's folder, for later runs to see what made it."""
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, "config" + os.path.splitext(source)[1])
    with open(source, encoding="utf-8") as f:
        write_text(f.read(), target)
    return target


def ledger_json(ledger: DataFrame, topic: str, numbers: str) -> DataFrame:
    """The whole ledger as one JSON object; a ledger has a row per topic."""
    return ledger.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(topic, numbers))))).alias("ledger"))


def write_text(text: str, path: str) -> None:
    """A small driver-made text (a report) by rename."""
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.tmp", path)


def dataset_dir(root: str, topic: str, name: str, seeded: bool = False) -> str:
    """<root>/<data type>/<topic>/<dataset>."""
    return os.path.join(root, "semi_synthetic_data" if seeded else "synthetic_data", topic, name)
