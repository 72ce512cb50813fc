"""Every query of the subpackage over empty tables and over tables of nulls: a defined, mostly empty result."""

import os

import pytest
from pyspark.sql import functions as F

from sievework.llm import queries


@pytest.fixture(scope="module")
def folders(spark, sf, tmp_path_factory):
    made = {}
    for kind in ("empty", "nulls"):
        made[kind] = str(tmp_path_factory.mktemp(kind))
        for name in os.listdir(sf):
            df = spark.read.parquet(f"{sf}/{name}")
            rows = df.limit(0) if kind == "empty" else df.limit(3).select(*(F.when(F.lit(False), F.col(c)).alias(c) for c in df.columns))
            rows.write.parquet(f"{made[kind]}/{name}")
    return made


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables_and_nulls(spark, folders, name):
    got = {kind: queries.QUERIES[name](spark, folder).count() for kind, folder in folders.items()}
    # a row per value, rule or policy is all that comes of nothing; a null solution is an empty one
    per_row = {"p1_clean": 9, "p3_found": 3, "p3_scores": 3, "p4_shares": 3, "p4_ablation": 13, "p4_policies": 3, "p4_runs": 3, "p8_ids": 3, "p10_redacted": 3, "p5_rates": 1}
    assert got["nulls"] == per_row.get(name, got["empty"])
    assert got["empty"] == 0
