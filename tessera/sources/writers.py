"""Writers of rows, logs, manifests and image files."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tessera.sources.readers import json_list


def jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines with nulls kept and text as it is."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def parquet_to_jsonl(spark: SparkSession, source: str, path: str) -> str:
    return jsonl(spark.read.parquet(source), path)


def append_line(path: str, record: dict) -> None:
    """Add a record to a driver-side log."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, ensure_ascii=False) + "\n")


def append_iteration(path: str, record: dict) -> list:
    """Add a record to a JSON list file; a missing or broken file starts anew."""
    found = [*json_list(path), record]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(found, f, indent=2, ensure_ascii=False)
    return found


def log_metrics(path: str, records: list[dict]) -> str:
    """Append metric records; an evaluation may be logged twice, and folding is indifferent to that."""
    for r in records:
        append_line(path, r)
    return path


def manifest(folder: str, summary: dict) -> str:
    return document(os.path.join(folder, "manifest.json"), summary)


def document(path: str, value: object) -> str:
    """One JSON value as a file of the driver."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False, default=str)
    return path


def write_once(folder: str, name: str, content: bytes) -> str:
    """Write a file under its whole name at once, unless it is there already; its path."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    if not os.path.exists(path):
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(content)
        os.replace(part, path)
    return path


def image_files(df: DataFrame, folder: str) -> DataFrame:
    """Write (name, content) to files below a folder that all executors share, and return (name, path); a file that is
    there already is left alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"name": b["name"], "path": [write_once(folder, n, bytes(c)) for n, c in zip(b["name"], b["content"])]})

    return df.select("name", "content").mapInPandas(run, "name string, path string")


def upload_format(path: str) -> str:
    """How a data set at `path` would be opened for publishing."""
    if os.path.isdir(path):
        return "folder"
    if os.path.splitext(path)[1].lower() in (".json", ".jsonl"):
        return "json"
    raise ValueError(f"cannot publish {path}: neither a folder nor JSON")
