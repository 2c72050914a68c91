"""Writing documents, logs and reports. Outputs are new versions: nothing is changed or deleted in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPTIONAL = ("dramatic_poem", "diplomatic_edition")


def as_json(df: DataFrame, pretty: bool = False) -> Column:
    """Each row as JSON with its nulls; optional keys are left out where they are null."""
    always = [c for c in df.columns if c not in OPTIONAL]
    cases = F.to_json(F.struct(*always), {"ignoreNullFields": "false", "pretty": str(pretty).lower()})
    for extra in [c for c in OPTIONAL if c in df.columns]:
        with_it = F.to_json(F.struct(*always, extra), {"ignoreNullFields": "false", "pretty": str(pretty).lower()})
        cases = F.when(F.col(extra).isNotNull(), with_it).otherwise(cases)
    return cases


def write_files(df: DataFrame, folder: str, name: str = "file_name") -> None:
    """One JSON file per row, named by a column, indented by two and with characters as they are. Written by the executors to a folder that they share: a path or an address of a file system that Arrow knows (file, hdfs, s3, gs)."""
    import json
    import os

    import pyarrow.fs as fs

    rows = df.select(F.col(name).alias("_name"), as_json(df.drop(name)).alias("_json"))

    def write(part):
        system, base = fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
        system.create_dir(base, recursive=True)
        for row in part:
            at = f"{base.rstrip('/')}/{os.path.basename(row['_name'])}"
            with system.open_output_stream(f"{at}.part") as f:
                f.write((json.dumps(json.loads(row["_json"]), ensure_ascii=False, indent=2) + "\n").encode("utf-8"))
            system.move(f"{at}.part", at)  # a task that runs again leaves whole files

    rows.foreachPartition(write)


def write_version(df: DataFrame, path: str, *partition_by: str) -> None:
    """A table as Parquet; an earlier version at the path is replaced as a whole."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Appends rows to an audit log, with the time."""
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").json(path)


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)


def markdown(df: DataFrame, heading: str, limit: int = 10_000) -> str:
    """A report table as Markdown, for people; a report of more rows than limit is refused, not cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: write them as a table")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {heading} ({len(rows)})", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"
