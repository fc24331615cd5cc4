"""Rendering prompts, asking an annotator for each row, and checking what it returns."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import jsontext, validate
from tessera.sources.connectors import Request, persistent

TEXT_TASK = (
    "From the source text write training material in {language} that stands on its own and never mentions a text. "
    "Return one JSON object with knowledge_qa (3 to 7 pairs of question and answer), detailed_explanation and "
    "analytical_reasoning (instruction, response each), conversational_exchange (opening_question, opening_response, "
    "follow_up_question, follow_up_response) and metadata (language, topics, domain)."
)
IMAGE_TASK = (
    "Describe the picture in {language} as one JSON object with info, caption (text), vqa (3 to 7 pairs of question and "
    "answer), ocr, reason and instruct_follow (instruction and answer each)."
)
SCHEMA = "id string, success boolean, data string, error string"


def text_prompt(text: Column | str, language: str) -> Column:
    return F.concat(F.lit(TEXT_TASK.format(language=language) + "\n\nSOURCE TEXT:\n"), F.col(text) if isinstance(text, str) else text)


def image_prompt(hint: Column | str, language: str) -> Column:
    hint = F.col(hint) if isinstance(hint, str) else hint
    return F.concat(F.lit(IMAGE_TASK.format(language=language)), F.when(F.coalesce(hint, F.lit("")) != "", F.concat(F.lit("\nTopic: "), hint)).otherwise(""))


def annotated(items: DataFrame, annotator, system: str | None = None, check=None, batch_size: int = 5, delay: float = 0.0, attempts: int = 3, retry_delay: float = 2.0) -> DataFrame:
    """(id, success, data, error) for each row of (item_id, message[, images]).

    A task keeps `batch_size` requests in flight and pauses for `delay` seconds between such batches; a request that still
    fails after its attempts is a failed row and touches no other. `check` validates the payload. Plain filters are not pushed through this step, so
    filter before it; and write its result before using it twice, or the annotator is asked twice.
    """
    pictures = "images" in items.columns

    def one(ident: str, message: str, images) -> tuple:
        request = Request(ident, message, system, tuple(images) if images is not None else ())
        try:
            data = persistent(lambda: jsontext.extract_json(annotator.complete(request)), attempts, retry_delay)
        except Exception as e:
            return ident, False, None, str(e)
        if check is not None:
            try:
                data = validate.validated(check, data)
            except validate.Invalid as e:
                return ident, False, None, f"schema: {e}"
        return ident, True, json.dumps(data, ensure_ascii=False), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, size = False, max(1, batch_size)
        with ThreadPoolExecutor(size) as pool:
            for b in batches:
                todo = list(zip(b["item_id"], b["message"], b["images"] if pictures else [None] * len(b)))
                rows: list[tuple] = []
                for i in range(0, len(todo), size):
                    if asked and delay:
                        time.sleep(delay)
                    asked = True
                    rows += pool.map(lambda r: one(*r), todo[i : i + size])
                yield pd.DataFrame(rows, columns=["id", "success", "data", "error"])

    return items.select("item_id", "message", *(["images"] if pictures else [])).mapInPandas(run, SCHEMA)


def annotate_texts(items: DataFrame, annotator, language: str, **options) -> DataFrame:
    """Annotation rows of (item_id, text)."""
    return annotated(items.select("item_id", text_prompt("text", language).alias("message")), annotator, None, validate.TEXT_ANNOTATION, **options)


def annotate_images(items: DataFrame, annotator, language: str, **options) -> DataFrame:
    """Annotation rows of (item_id, image_path, topic_hint)."""
    ask = items.select("item_id", image_prompt("topic_hint", language).alias("message"), F.array("image_path").alias("images"))
    return annotated(ask, annotator, None, validate.IMAGE_ANNOTATION, **options)


def checked(payload: Column, check) -> Column:
    """struct(valid, data, error) of JSON payloads: parsed, validated, in normal form."""

    @F.pandas_udf("valid boolean, data string, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append((True, json.dumps(validate.validated(check, json.loads(t)), ensure_ascii=False), None))
            except validate.Invalid as e:
                rows.append((False, None, f"schema: {e}"))
            except (TypeError, ValueError) as e:
                rows.append((False, None, f"json: {e}"))
        return pd.DataFrame(rows, columns=["valid", "data", "error"])

    return run(payload)


def first_fault(faults: list[tuple[Column, str]]) -> Column:
    """Name of the first fault whose condition holds, null where none does; conditions that are null count as faults."""
    out = F.lit(None).cast("string")
    for holds, name in reversed(faults):
        out = F.when(F.coalesce(holds, F.lit(True)), F.lit(f"schema: {name}")).otherwise(out)
    return out


def text_fault(a: Column) -> Column:
    """What is wrong with a typed text annotation, as a built-in expression."""
    blank = lambda c: c.isNull() | (c == "")
    qa = a["knowledge_qa"]
    pairs = F.exists(qa, lambda x: blank(x["question"]) | blank(x["answer"]))
    talk, meta = a["conversational_exchange"], a["metadata"]
    return first_fault([
        (~F.size(qa).between(3, 7), "knowledge_qa"), (pairs, "knowledge_qa"),
        *((blank(a[p][f]), p) for p in ("detailed_explanation", "analytical_reasoning") for f in ("instruction", "response")),
        *((blank(talk[f]), "conversational_exchange") for f in ("opening_question", "opening_response", "follow_up_question", "follow_up_response")),
        (blank(meta["language"]), "metadata.language"), (F.size(meta["topics"]) < 1, "metadata.topics"), (blank(meta["domain"]), "metadata.domain"),
    ])


def stats(items: DataFrame, annotations: DataFrame, examples: DataFrame) -> dict:
    """Counts of a build."""
    a = annotations.agg(F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("bad")).first()
    return {"num_items": items.count(), "num_annotations": a["ok"], "num_examples": examples.count(), "num_failures": a["bad"]}


def failed_items(items: DataFrame, annotations: DataFrame) -> DataFrame:
    return items.join(annotations.where("not success").select(F.col("id").alias("item_id")), "item_id", "left_semi")
