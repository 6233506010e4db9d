"""Queries of text, numbers and geometry on small tables written for them."""

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from talkweave.functions import ocr

TRANSCRIPT = "meeting_id string, pos bigint, start_s double, end_s double"
EVENTS = "meeting_id string, pos bigint, start double, end double, display_name string, layout string, signal string, confidence double"


def run(spark, folder, query, name, data, schema):
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return entry.queries()[query](spark, str(folder))


def test_samples_of_long_recordings_are_whole(spark, tmp_path):
    short = [("m", 0, 134217.727, 134218.5), ("m", 0, 134217.727, 134218.5), ("m", 1, 1.5, None)]
    d = run(spark, tmp_path / "short", "derived_end", "transcript", short, TRANSCRIPT)
    assert dict(d.dtypes)["first_sample"] == "int"
    assert [tuple(r) for r in d.collect()] == [("m", 0, 134218.5, 2147483632, 134217.727)]
    d = run(spark, tmp_path / "long", "derived_end", "transcript", [*short, ("m", 2, 289191.067, 289192.775)], TRANSCRIPT)
    assert dict(d.dtypes)["first_sample"] == "bigint"
    assert sorted(tuple(r) for r in d.collect()) == [("m", 0, 134218.5, 2147483632, 134217.727), ("m", 2, 289192.775, 4627057072, 289191.067)]


def test_mean_confidence_is_exact_in_any_order(spark):
    tie = [0.72, 0.871, 0.675, 0.853, 0.678, 0.621, 0.721, 0.856, 0.437, 0.665, 0.544, 0.8, 0.828, 0.626, 0.632, 0.76]
    cases = [tie, tie[::-1], sorted(tie), [0.7, 0.6, 0.2], [0.2, 0.6, 0.7], [0.9, None, 0.2], [None], [], [1e15, 3e15], [float("inf")]]
    pages = [([("t", c, 0.0, 0.0, 0.0, 1.0) for c in cs],) for cs in cases]
    mean = ocr.mean_confidence(F.col("page"))
    got = spark.createDataFrame(pages, f"page array<{ocr.LINE}>").select(F.round(mean, 6), ocr.needs_fallback(F.col("page"), F.lit(True))).collect()
    assert [r[0] for r in got] == [0.705438] * 3 + [0.5, 0.5, 0.55, None, None, 2e15, float("inf")]
    assert [r[1] for r in got] == [False] * 6 + [True, True, False, False]


def test_pages_are_read_again_as_the_sql_says(spark, tmp_path):
    pages = {0: [0.7, 0.6, 0.2], 1: [0.2, 0.6, 0.7], 2: [0.4, None, 0.3], 3: [0.9, None], 4: [None, None], 5: [0.4999996], 6: [0.499, 0.5]}
    data = [("m", minute * 10 + i, minute * 60.0 + i, None, "Ana", "gallery_view", "active_speaker_border", c) for minute, cs in pages.items() for i, c in enumerate(cs)]
    data += [("early", i, -0.5 - i, None, "Ana", "gallery_view", "active_speaker_border", 0.4) for i in range(2)]
    got = sorted(tuple(r) for r in run(spark, tmp_path, "avg_conf_gate", "visual_speaker_events", data, EVENTS).collect())
    db = duckdb.connect()
    for name in ("speaker_turns", "transcript", "scenes"):
        db.execute(f"create table {name} (meeting_id varchar, pos bigint, start double, \"end\" double, start_s double, end_s double, \"timestamp\" double, speaker_id varchar, text varchar, language varchar, frame_path varchar)")
    db.execute(f"create view visual_speaker_events as select * from '{tmp_path}/visual_speaker_events.parquet/*.parquet'")
    assert got == sorted(db.execute(entry.oracle_sql()["avg_conf_gate"]).fetchall())
    assert [r[2:] for r in got] == [(0.4, True, 1), (0.5, False, 3), (0.5, False, 3), (0.35, True, 1), (0.9, False, 2), (None, None, 2), (0.5, False, 1), (0.4995, True, 1)]
