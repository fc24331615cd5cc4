"""Looking at, rendering, splitting and tokenising data sets."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions import text as T
from tessera.functions.order import ordinal

# Columns that are taken for text.
TEXT_COLUMNS = ("text", "prompt", "response", "instruction", "output")
_TEXT_SIGNS = {*TEXT_COLUMNS, "messages", "input", "content", "conversations"}
_IMAGE_SIGNS = {"image", "images", "image_path", "img", "pixel_values"}


def modality(columns: Iterable[str]) -> list[str]:
    """What the columns could be trained on."""
    names = {c.lower() for c in columns}
    text, image = bool(names & _TEXT_SIGNS), bool(names & _IMAGE_SIGNS)
    return ["text"] * text + ["image"] * image + ["multimodal"] * (text and image)


def missing(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, Column]:
    """For each text column, the count of its null or blank values as an aggregate."""
    names = [c for c in (TEXT_COLUMNS if columns is None else columns) if c in df.columns]
    return {c: F.count_if(F.col(c).isNull() | (T.strip(F.col(c).cast("string")) == "")) for c in names}


def warnings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column, n_missing): text columns with null or blank values, all counted in one pass."""
    counts = missing(df, columns)
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, n_missing long")
    one = df.agg(*(c.alias(n) for n, c in counts.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("column"), F.col(n).alias("n_missing")) for n in counts))).alias("x")).select("x.*").where("n_missing > 0")


def warning_texts(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    return [f"column {r['column']}: {r['n_missing']} empty or missing values" for r in warnings(df, columns).orderBy("column").collect()]


def rendered(messages: Column) -> Column:
    """A chat as one text: `<|role|>` and the content on lines of their own."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"])), "\n")


def chats(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """(key, messages) of a long table of turns."""
    said = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(content).alias("content"))))
    return turns.groupBy(key).agg(said.alias("m")).select(key, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def formatted(df: DataFrame) -> Column:
    """Training text of a row: its messages rendered, else its text, else prompt and response as lines."""
    if "messages" in df.columns:
        return rendered(F.col("messages"))
    if "text" in df.columns:
        return F.col("text")
    return F.concat_ws("\n", *(F.col(c) for c in ("prompt", "instruction", "input", "response", "output") if c in df.columns))


def input_output(messages: Column) -> Column:
    """struct(prompt, reference): all before the last assistant turn, and that turn (null without one)."""
    places = F.transform(messages, lambda m, i: F.when(m["role"] == "assistant", i))
    last = F.array_max(places)
    return F.struct(
        rendered(F.when(last.isNull(), messages).otherwise(F.slice(messages, F.lit(1), F.coalesce(last, F.lit(0))))).alias("prompt"),
        F.when(last.isNotNull(), F.element_at(messages, last + 1)["content"]).alias("reference"),
    )


def preview(df: DataFrame, length: int = 500) -> dict:
    """The first row, long texts cut; an empty table gives an empty dict."""
    short = [F.substring(c.name, 1, length).alias(c.name) if isinstance(c.dataType, StringType) else F.col(c.name) for c in df.schema]
    row = df.select(*short).first()
    return row.asDict(recursive=True) if row else {}


def summary(df: DataFrame, data_path: str, resolved: str | None = None) -> dict:
    return {
        "data_path": data_path, "resolved_data_id": resolved or data_path, "columns": df.columns, "sample_count": df.count(),
        "example": preview(df), "modality_candidates": modality(df.columns), "validation_warnings": warning_texts(df),
    }


def head(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows in order; all where n is null or 0."""
    return df.orderBy(*order).limit(n) if n else df


def split(df: DataFrame, key: str, seed: int = 42, share: float = 0.05, least: int = 10) -> DataFrame:
    """All columns and `is_test`: exactly ceil(share * n) rows in the order of a seeded hash, none up to `least` rows."""
    n = df.count()
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    if n <= least:
        return df.withColumn("is_test", F.lit(False))
    size = -(-n * round(share * 10_000) // 10_000)
    return ordinal(hashed, "_h", key, name="_o").withColumn("is_test", F.col("_o") <= size).drop("_h", "_o")


def tokenised(df: DataFrame, tokenizer, length: int, text_col: str = "text") -> DataFrame:
    """Columns input_ids, attention_mask and labels, cut or padded to `length`."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: tokenizer.encode(t or "")[:length])

    pad = getattr(tokenizer, "pad", 0)
    n = F.size("_ids")
    ids = F.concat("_ids", F.array_repeat(F.lit(pad), F.lit(length) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))
    return df.withColumn("_ids", encode(text_col)).withColumn("input_ids", ids).withColumn("attention_mask", mask).withColumn("labels", F.col("input_ids")).drop("_ids")
