"""Readers of texts, images, logs and data sets."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import jsontext
from tessera.functions import text as T


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """A Parquet table of a folder; with `spread`, one with fewer splits than there are cores, such as a single small
    file, is dealt out over them before costly work on its rows."""
    df, cores = spark.read.parquet(f"{folder}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a line file, from 1, blank lines counted.

    Splits of one file are consecutive, so the number of a line is its place in its split plus the lines of the splits
    before; only one count a split reaches the driver.
    """
    held = spark.read.text(path).coalesce(1) if _small(path) else spark.read.text(path)
    rows = held.select("value", F.monotonically_increasing_id().alias("_id"), F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    sizes = sorted((r["_f"], r["_b"], r["lo"], r["n"]) for r in rows.groupBy("_f", "_b").agg(F.min("_id").alias("lo"), F.count("*").alias("n")).collect())
    offset, at = {}, 1
    for f, b, lo, n in sizes:
        offset[(f, b)] = at - lo
        at += n
    if not offset:
        return rows.select(F.lit(0).cast("long").alias("line_no"), "value").limit(0)
    keys = spark.createDataFrame([(f, b, o) for (f, b), o in offset.items()], "_f string, _b long, _o long")
    return rows.join(keys, ["_f", "_b"]).select((F.col("_id") + F.col("_o")).alias("line_no"), "value")


def _small(path: str) -> bool:
    return os.path.isfile(path) and os.path.getsize(path) < 32 << 20


def item_id(id_: Column, source_id: Column, line_no: Column) -> Column:
    """The id, else the source id, else `line_<n>`; empty text counts as missing."""
    return F.coalesce(T.falsy(id_), T.falsy(source_id), F.concat(F.lit("line_"), line_no.cast("string")))


def texts_from_jsonl(spark: SparkSession, path: str, text_field: str = "text") -> DataFrame:
    """(line_no, item_id, text): blank lines skipped, a malformed line fails the read, empty texts dropped; a JSON null
    is the text "None", a missing field no text."""
    lines = numbered_lines(spark, path).where(T.strip(F.col("value")) != "")
    v = lines.select("line_no", F.parse_json("value").alias("v"))
    get = lambda f: F.try_variant_get("v", f'$["{f}"]', "string")
    has = F.expr(f"map_contains_key(try_variant_get(v, '$', 'map<string,variant>'), '{text_field}')")
    text = F.when(has, F.coalesce(get(text_field), F.lit("None")))
    # Zero, empty and false ids fall through, but the text "0" is an id.
    number = lambda f: F.schema_of_variant(F.variant_get("v", f'$["{f}"]', "variant"))
    some = lambda f: F.when((get(f) != "") & ~((get(f).isin("0", "0.0", "false")) & (number(f) != "STRING")), get(f))
    ident = F.coalesce(some("id"), some("source_id"), F.concat(F.lit("line_"), F.col("line_no").cast("string")))
    return v.select("line_no", ident.alias("item_id"), T.strip(text).alias("text")).where("text <> ''")


def texts_from_dir(spark: SparkSession, folder: str) -> DataFrame:
    """(item_id, text) of every .txt file below a folder, stripped, empty ones dropped."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("item_id"), T.strip(F.col("value")).alias("text")).where("text <> ''")


def images(spark: SparkSession, folder: str, extensions: Iterable[str] = (".jpg", ".jpeg", ".png", ".webp")) -> DataFrame:
    """(item_id, image_path, topic_hint): image files below a folder; the hint is the parent folder's name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    return files.where(suffix.isin([e.lower() for e in extensions])).select(F.col("path").alias("item_id"), F.col("path").alias("image_path"), F.element_at(F.split("path", "/"), -2).alias("topic_hint"))


def tolerant_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, json) of the lines that hold an object, whole or inside other text; a missing file has none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "line_no long, json string")
    return numbered_lines(spark, path).select("line_no", jsontext.tolerant(F.col("value")).alias("json")).where("json is not null")


METRICS = "step int, loss double, train_loss double, eval_loss double"


def metrics_log(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, step, loss, train_loss, eval_loss); strict, a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "line_no long, " + METRICS)
    lines = numbered_lines(spark, path).where(T.strip(F.col("value")) != "")
    return lines.select("line_no", F.from_json("value", METRICS, {"mode": "FAILFAST"}).alias("r")).select("line_no", "r.*")


def predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id long, input string, prediction string, reference string").option("mode", "FAILFAST").json(path)


def dataset(spark: SparkSession, path: str, split: str = "train") -> tuple[DataFrame, str]:
    """A data set and its resolved name: .json/.jsonl, .parquet, .csv, .orc, or a folder with or without splits."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix in (".json", ".jsonl"):
        return spark.read.json(path), path
    if suffix in (".parquet", ".orc", ".csv"):
        return spark.read.format(suffix[1:]).options(**({"header": "true"} if suffix == ".csv" else {})).load(path), path
    inner = f"{path.rstrip('/')}/{split}"
    if _exists(spark, inner):
        return dataset(spark, inner, split)
    if not _exists(spark, path):
        raise ValueError(f"no data set at {path}")
    names = [str(f.getPath().getName()) for f in _listed(spark, path)]
    return (spark.read.json(path) if any(n.endswith((".json", ".jsonl")) for n in names) else spark.read.parquet(path)), path


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def _listed(spark: SparkSession, path: str):
    fs, p = _path(spark, path)
    return list(fs.listStatus(p))


def prompt(folder: str, name: str, /, **values) -> str:
    """A template file with its fields filled in."""
    with open(os.path.join(folder, name), encoding="utf-8") as f:
        return f.read().format(**values)


def json_list(path: str) -> list:
    """The list in a file, empty where it is missing, broken or no list."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except (OSError, ValueError):
        return []
    return found if isinstance(found, list) else []
