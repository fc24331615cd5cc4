import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tessera.operators import dataset, metrics
from tessera.sources.config import PipelineConfig, TrainConfig
from tessera.sources.connectors import WordTokenizer

CHAT = "messages array<struct<role string, content string>>"
LOG = "line_no long, step int, loss double, train_loss double, eval_loss double"


def test_modality_and_warnings(spark):
    assert "text" in dataset.modality(["messages", "id"]) and "text" in dataset.modality(["text"])
    assert dataset.modality(["image", "text"]) == ["text", "image", "multimodal"] and dataset.modality(["x"]) == []
    df = spark.createDataFrame([("hello", 1), ("", 2), ("world", 3)], "text string, other int")
    assert len(dataset.warning_texts(df)) == 1 and "empty" in dataset.warning_texts(df)[0]
    assert dataset.warning_texts(df.where("text <> ''")) == [] and dataset.warning_texts(df.select("other")) == []


def test_chat_rendering(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", "yo"), ("user", "more")],), ([("system", "s")],)], CHAT)
    a, b = df.select(dataset.formatted(df).alias("t"), dataset.input_output(F.col("messages")).alias("p")).collect()
    assert a.t == "<|user|>\nhi\n<|assistant|>\nyo\n<|user|>\nmore"
    assert (a.p.prompt, a.p.reference) == ("<|user|>\nhi", "yo")
    assert (b.p.prompt, b.p.reference) == ("<|system|>\ns", None)
    text = spark.createDataFrame([("plain",)], "text string")
    assert text.select(dataset.formatted(text)).first()[0] == "plain"


@pytest.mark.parametrize("n", [0, 10, 11, 20, 21, 1000])
def test_split_is_exact(spark, n):
    got = dataset.split(spark.range(n), "id")
    assert got.where("is_test").count() == (math.ceil(n / 20) if n > 10 else 0)
    assert got.count() == n
    if n == 20:
        assert {r.id for r in got.where("is_test").collect()} == {r.id for r in dataset.split(spark.range(n).repartition(5), "id").where("is_test").collect()}


def test_summary_head_and_tokens(spark):
    df = spark.createDataFrame([(2, "b " * 900), (1, "a c"), (3, None)], "id int, text string")
    s = dataset.summary(df, "p")
    assert s["sample_count"] == 3 and s["columns"] == ["id", "text"] and len(s["example"]["text"]) == 500 and len(s["validation_warnings"]) == 1
    assert dataset.summary(df.limit(0), "p")["example"] == {}
    assert [r.id for r in dataset.head(df, 2, "id").collect()] == [1, 2] and dataset.head(df, None, "id").count() == 3
    rows = {r.id: r for r in dataset.tokenised(df, WordTokenizer(), 4).collect()}
    assert [len(r.input_ids) for r in rows.values()] == [4] * 3
    assert rows[1].attention_mask == [1, 1, 0, 0] and rows[3].attention_mask == [0] * 4 and rows[2].labels == rows[2].input_ids


def test_metrics_folding(spark):
    fold = lambda rows: tuple(metrics.summary(spark.createDataFrame(rows, LOG)).first())
    assert fold([]) == (0, None, None, None)
    assert fold([(1, 5, 2.0, 9.0, None), (2, 10, None, 3.0, 1.5), (3, 10, None, None, 1.5), (4, None, None, None, 1.7), (5, 7, None, None, None)]) == (10, 1.5, 3.0, 1.7)
    assert metrics.tail(spark.range(40).toDF("line_no")).count() == 25


def test_best_trial(spark):
    best = lambda rows: [r.trial for r in metrics.best_trial(spark.createDataFrame(rows, "trial int, best_eval_loss double, last_train_loss double")).collect()]
    assert best([(0, 2.0, 1.0), (1, 1.0, 9.0), (2, 1.0, 0.1)]) == [1]
    assert best([(0, 0.0, 0.5), (1, 0.6, 9.0)]) == [0] and best([(0, None, None), (1, 0.0, None)]) == []


def test_tuning(spark):
    bounds, base = metrics.Bounds(), TrainConfig()
    tried = metrics.candidates(base, bounds, 5, 1)
    assert tried[0] == base and tried == metrics.candidates(base, bounds, 5, 1) and len(tried) == 5 and len(metrics.candidates(base, bounds, 0, 1)) == 1
    assert all(bounds.min_lr <= t.lr <= bounds.max_lr and 50 <= t.max_steps <= 1000 for t in tried)
    for m, d in ((100.0, 99), (1e-9, -99)):
        change = {"lr_multiplier": m, "batch_size_delta": d, "grad_accum_delta": d, "max_steps_delta": 100 * d}
        got = metrics.adjusted(base, change, bounds)
        assert got == replace(base, **({"lr": 5e-4, "batch_size": 16, "grad_accum": 16, "max_steps": 1000} if d > 0 else {"lr": 1e-5, "batch_size": 1, "grad_accum": 1, "max_steps": 50}))
        row = spark.createDataFrame([(base.as_dict() | change)]).transform(metrics.moved).first()
        assert (row.lr, row.batch_size, row.grad_accum, row.max_steps) == (got.lr, got.batch_size, got.grad_accum, got.max_steps)


def test_config():
    env = {"COUNTRY": "X", "MAX_STEPS": "7", "COLLECT_IMAGES": "yes", "HF_MODEL_ID": "", "SEARCH_TRIALS": "9", "OPENAI_API_KEY": "k"}
    cfg = PipelineConfig.from_env(env, hf_model_id="m", sft_target_language="en", max_steps=8)
    assert (cfg.country, cfg.max_steps, cfg.collect_images, cfg.search_trials, cfg.llm_api_key) == ("X", 8, True, 0, "k")
    assert cfg.train_config().max_steps == 8
    for bad in ({"hf_model_id": "m"}, {"hf_model_id": "m", "sft_target_language": "en", "nope": 1}):
        with pytest.raises(ValueError):
            PipelineConfig.from_env(env, **bad)
