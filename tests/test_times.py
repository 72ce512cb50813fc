"""Attempt times in every notation, against the standard library."""

from datetime import datetime, timezone

from sievework import queries as core

TEXTS = ["2025-07-06T21:16:02.250000+00:00", "2025-07-06T21:16:02+05:30", "2025-07-06T21:16:02-0800", "2025-07-06T21:16:02Z", "2025-07-06T21:16:02", "soon", "", None]


def micros(text):
    try:
        at = datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return round((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1e6)


def test_every_row_is_parsed(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "attempt_id bigint, attempt_ts string").write.parquet(f"{tmp_path}/model_solutions.parquet")
    got = {r.attempt_id: r.micros for r in core.QUERIES["attempt_times"](spark, str(tmp_path)).collect()}
    assert got == {k: micros(t) for k, t in enumerate(TEXTS)} and sum(v is not None for v in got.values()) == 5
