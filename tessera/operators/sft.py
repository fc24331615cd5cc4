"""Chat-format training examples from annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

PAIR = "struct<instruction string, response string>"
TEXT_SCHEMA = (
    f"struct<knowledge_qa array<struct<question string, answer string>>, detailed_explanation {PAIR}, analytical_reasoning {PAIR}, "
    "conversational_exchange struct<opening_question string, opening_response string, follow_up_question string, follow_up_response string>, "
    "metadata struct<language string, topics array<string>, domain string>>"
)
ANSWERED = "struct<instruction string, answer string>"
IMAGE_SCHEMA = f"struct<caption struct<text string>, vqa array<struct<question string, answer string>>, ocr {ANSWERED}, reason {ANSWERED}, instruct_follow {ANSWERED}>"

# Fixed value: the instruction for captions.
CAPTION = "Describe this image in detail."


def last_items(items: DataFrame, order: str) -> DataFrame:
    """One row of each item_id: the last in order."""
    return items.withColumn("_n", F.row_number().over(W.partitionBy("item_id").orderBy(F.col(order).desc()))).where("_n = 1").drop("_n")


def joined(annotations: DataFrame, items: DataFrame, order: str) -> DataFrame:
    """Successful annotations with their items."""
    return annotations.where("success").join(last_items(items, order).withColumnRenamed("item_id", "id"), "id")


def _said(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _turns(*contents: Column) -> Column:
    return F.array(*(_said("assistant" if i % 2 else "user", c) for i, c in enumerate(contents)))


def text_examples(a: Column) -> Column:
    """array of messages arrays: one for each pair, the explanation, the reasoning, and the four-message conversation."""
    talk = a["conversational_exchange"]
    rest = F.array(
        *(_turns(a[p]["instruction"], a[p]["response"]) for p in ("detailed_explanation", "analytical_reasoning")),
        _turns(talk["opening_question"], talk["opening_response"], talk["follow_up_question"], talk["follow_up_response"]),
    )
    return F.concat(F.transform(a["knowledge_qa"], lambda x: _turns(x["question"], x["answer"])), rest)


def _part(kind: str, value: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(kind).alias("type"), (value if kind == "text" else none).alias("text"), (value if kind == "image" else none).alias("image"))


def _seen(instruction: Column, answer: Column, path: Column) -> Column:
    return F.array(_said("user", F.array(_part("text", instruction), _part("image", path))), _said("assistant", F.array(_part("text", answer))))


def image_examples(a: Column, path: Column) -> Column:
    """The caption, each question, the text in the picture where both sides are given, the reasoning, the instruction."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    asked = lambda p: _seen(a[p]["instruction"], a[p]["answer"], path)
    ocr = F.filter(F.array(asked("ocr")), lambda _: some(a["ocr"]["instruction"]) & some(a["ocr"]["answer"]))
    return F.concat(F.array(_seen(F.lit(CAPTION), a["caption"]["text"], path)), F.transform(a["vqa"], lambda x: _seen(x["question"], x["answer"], path)), ocr, F.array(asked("reason"), asked("instruct_follow")))


def exploded(rows: DataFrame, examples: Column, *keep: str) -> DataFrame:
    """One row per example: the kept columns, ex_ord and messages."""
    return rows.select(*keep, F.posexplode(examples).alias("ex_ord", "messages"))


def text_sft(annotations: DataFrame) -> DataFrame:
    """(id, ex_ord, messages) of the successful rows of (id, success, data)."""
    typed = annotations.where("success").select("id", F.from_json("data", TEXT_SCHEMA).alias("a"))
    return exploded(typed, text_examples(F.col("a")), "id")


def image_sft(annotations: DataFrame, items: DataFrame) -> DataFrame:
    """(id, ex_ord, messages); paths come from the items (item_id, image_path), the last of equal ids winning."""
    rows = joined(annotations, items.withColumn("_at", F.monotonically_increasing_id()), "_at")
    typed = rows.select("id", "image_path", F.from_json("data", IMAGE_SCHEMA).alias("a"))
    return exploded(typed, image_examples(F.col("a"), F.col("image_path")), "id")


def well_formed(messages: Column) -> Column:
    """Whether a chat has an even number of non-empty messages that alternate from the user to the assistant."""
    turn = lambda m, i: (m["role"] == F.when(i % 2 == 0, F.lit("user")).otherwise("assistant")) & (F.coalesce(m["content"], F.lit("")) != "")
    numbered = F.transform(messages, lambda m, i: turn(m, i))
    return (F.size(messages) > 0) & (F.size(messages) % 2 == 0) & F.forall(numbered, lambda x: x)


def serialised(examples: DataFrame, *order: str) -> DataFrame:
    """One JSON array of the examples' messages for each id, in order; an id's examples are few by construction."""
    listed = F.array_sort(F.collect_list(F.struct(*(order or ("ex_ord",)), "messages")))
    return examples.groupBy("id").agg(listed.alias("x")).select("id", F.to_json(F.transform("x", lambda e: F.struct(e["messages"].alias("messages")))).alias("examples"))
