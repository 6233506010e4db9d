"""Stored artifacts: JSON files of one meeting per folder, read and written by their schema.

A file holds either a bare array of rows, an object, or an object that wraps the rows. Tables of many meetings are
parquet, partitioned by meeting, where a meeting that is already there may be skipped.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.schemas import ARTIFACTS, REQUIRED
from talkweave.sources import files


class InvalidArtifact(ValueError):
    """A stored file that lacks required fields."""


def artifact_path(folder: str, name: str, explicit: str | None = None) -> str:
    """The explicit path if one is given, else the artifact's usual file in the folder."""
    return explicit or os.path.join(folder, ARTIFACTS[name][0])


def _row_schema(name: str) -> str:
    return ARTIFACTS[name][2]


def empty(spark: SparkSession, name: str) -> DataFrame:
    """The artifact without rows, for optional inputs that are missing."""
    schema = "speaker_id string, name string" if name == "speaker_names" else _row_schema(name)
    return spark.createDataFrame([], f"meeting_id string, pos bigint, {schema}")


def read_artifact(spark: SparkSession, name: str, paths: str | list[str], optional: bool = False) -> DataFrame:
    """Rows of one kind of artifact, of one or many files (a path may be a glob): meeting_id, pos, fields.

    meeting_id is the name of the file's folder, pos the row's place in the file. The schema is declared, never
    inferred; files are read in parallel, one per task at least. A missing file gives no rows if ``optional``. A row
    without a required field raises InvalidArtifact when the result is computed by ``checked``.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    missing = [p for p in wanted if "*" not in p and not files.exists(p)]
    if missing and optional:
        wanted = [p for p in wanted if p not in missing]
        if not wanted:
            return empty(spark, name)
    elif missing:
        raise FileNotFoundError(missing[0])
    _, wrapper, schema = ARTIFACTS[name]
    if name == "speaker_names":
        rows = spark.read.schema(f"{schema}, _bad string").option("multiLine", True).json(wanted).withColumn("_file", F.input_file_name())
        return rows.select(_meeting(), F.posexplode("mapping").alias("pos", "speaker_id", "name")).withColumn("pos", F.col("pos").cast("bigint"))
    read = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    if wrapper:
        rows = read.schema(f"{wrapper} array<struct<{_as_struct(schema)}>>").json(wanted).select(_meeting(F.input_file_name()), F.posexplode(wrapper).alias("pos", "_r"))
        return rows.select("meeting_id", F.col("pos").cast("bigint").alias("pos"), "_r.*")
    # A bare array becomes one row per element, in order; whole files keep the order inside one partition.
    rows = spark.read.text(wanted, wholetext=True).select(_meeting(F.input_file_name()), F.col("value"))
    parsed = rows.select("meeting_id", F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{_as_struct(schema)}>>")).otherwise(F.array(F.from_json("value", f"struct<{_as_struct(schema)}>"))).alias("_rows"))
    return parsed.select("meeting_id", F.posexplode("_rows").alias("pos", "_r")).select("meeting_id", F.col("pos").cast("bigint").alias("pos"), "_r.*")


def _meeting(file=None):
    file = F.col("_file") if file is None else file
    return F.url_decode(F.regexp_replace(F.regexp_extract(file, r"([^/]+)/[^/]+$", 1), r"\+", "%2B")).alias("meeting_id")


def _as_struct(ddl: str) -> str:
    """'a int, b array<..>' -> 'a:int,b:array<..>' at the top level."""
    out, depth, part = [], 0, ""
    for c in ddl + ",":
        if c == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            part = ""
        else:
            depth += (c == "<") - (c == ">")
            part += c
    return ",".join(out)


def checked(rows: DataFrame, name: str) -> DataFrame:
    """Raise on rows that lack a required field, when they are computed."""
    required = REQUIRED.get(name, [])
    if not required:
        return rows
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    first = required[0]
    message = F.concat(F.lit(f"{name}: a row lacks one of {', '.join(required)}: "), F.to_json(F.struct(*required)))
    kind = rows.schema[first].dataType
    return rows.withColumn(first, F.when(lacking, F.raise_error(message).cast(kind)).otherwise(F.col(first)))


def write_artifact(rows: DataFrame, name: str, path: str) -> None:
    """Write the rows of one meeting as its JSON file, in the order of pos. For export; a table is the system of record.

    A meeting's artifact is small (thousands of rows); the rows are fetched one partition at a time and written as they
    come, so the file's size does not matter to the driver's memory.
    """
    _, wrapper, schema = ARTIFACTS[name]
    fields = [c for c in rows.columns if c not in ("meeting_id", "pos")]
    ordered = rows.orderBy("pos") if "pos" in rows.columns else rows
    with files.writing(path) as f:
        if name == "speaker_names":
            mapping = {r["speaker_id"]: r["name"] for r in ordered.toLocalIterator()}
            json.dump({"mapping": mapping}, f, indent=2, ensure_ascii=False)
            return
        lines = (r["_j"] for r in ordered.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_j")).toLocalIterator())
        if name in ("recordings", "insights"):
            f.write(json.dumps(json.loads(next(lines)), indent=2, ensure_ascii=False))
            return
        f.write(f'{{\n"{wrapper}": [' if wrapper else "[")
        for i, line in enumerate(lines):
            f.write(("," if i else "") + "\n  " + json.dumps(json.loads(line), indent=2, ensure_ascii=False).replace("\n", "\n  "))
        f.write("\n]\n}\n" if wrapper else "\n]\n")


def write_table(rows: DataFrame, path: str, overwrite_meetings: bool = True) -> DataFrame:
    """Write a table partitioned by meeting; only the meetings in ``rows`` are replaced. Returns the stored rows of those.

    With ``overwrite_meetings`` False, meetings that are stored already are left as they are and not computed again:
    they are filtered out before the write. There is no check whether their inputs have changed since.
    """
    spark = rows.sparkSession
    if not overwrite_meetings and files.exists(path):
        stored = spark.read.parquet(path).select("meeting_id").distinct()
        rows = rows.join(stored, "meeting_id", "left_anti")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("meeting_id").parquet(path)
    return spark.read.parquet(path)
