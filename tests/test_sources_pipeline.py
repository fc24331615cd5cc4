import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import annotate
from tessera.plans import decisions, registry, report
from tessera.plans.pipeline import Pipeline
from tessera.sources import readers, writers
from tessera.streaming import metrics as stream

LINES = ['{"text": " a "}', "", '{"text": null, "id": 0}', '{"id": "", "source_id": "s", "text": "b"}', '{"text": "  "}', '{"id": 7, "text": "c"}', '{"other": 1}', '{"id": "0", "text": 5}']


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_texts_from_jsonl(spark, tmp_path):
    got = readers.texts_from_jsonl(spark, write(tmp_path / "a.jsonl", *LINES)).orderBy("line_no").collect()
    assert [(r.item_id, r.text) for r in got] == [("line_1", "a"), ("line_3", "None"), ("s", "b"), ("7", "c"), ("0", "5")]
    with pytest.raises(Exception, match="MALFORMED|malformed|JSON"):
        readers.texts_from_jsonl(spark, write(tmp_path / "b.jsonl", '{"text": "a"}', "{bad")).collect()


def test_line_numbers_over_splits(spark, tmp_path):
    path = write(tmp_path / "long.txt", *(f"l{i}" for i in range(1, 3001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        small, readers._small = readers._small, lambda _: False
        got = readers.numbered_lines(spark, path).collect()
    finally:
        readers._small = small
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.value == f"l{r.line_no}" for r in got) and len(got) == 3000


def test_folders(spark, tmp_path):
    (tmp_path / "t" / "sub").mkdir(parents=True)
    write(tmp_path / "t" / "one.txt", " x ")
    write(tmp_path / "t" / "sub" / "two.txt", "y", "z")
    write(tmp_path / "t" / "blank.txt", " ")
    write(tmp_path / "t" / "no.md", "n")
    assert sorted(r.text for r in readers.texts_from_dir(spark, str(tmp_path / "t")).collect()) == ["x", "y\nz"]
    (tmp_path / "i" / "Cats").mkdir(parents=True)
    for n in ("a.JPG", "b.png", "c.gif"):
        (tmp_path / "i" / "Cats" / n).write_bytes(b"x")
    assert [r.topic_hint for r in readers.images(spark, str(tmp_path / "i")).collect()] == ["Cats", "Cats"]


def test_tolerant_and_strict_logs(spark, tmp_path):
    path = write(tmp_path / "l.jsonl", '{"a": 1}', "", 'junk {"a": 2} tail', "none", "{bad}")
    assert [json.loads(r.json) for r in readers.tolerant_jsonl(spark, path).orderBy("line_no").collect()] == [{"a": 1}, {"a": 2}]
    assert [x["a"] for x in report.records(path)] == [1, 2]
    assert readers.tolerant_jsonl(spark, str(tmp_path / "gone")).count() == 0 and report.records(str(tmp_path / "gone")) == []
    assert readers.metrics_log(spark, str(tmp_path / "gone")).count() == 0
    assert [r.step for r in readers.metrics_log(spark, write(tmp_path / "m", '{"step": 3, "loss": 1.5}', "")).collect()] == [3]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    writers.jsonl(df, str(tmp_path / "o"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "o").glob("part-*"))
    assert text == '{"a":1,"b":null,"c":"é"}\n'
    path = str(tmp_path / "it.json")
    assert len(writers.append_iteration(path, {"x": 1})) == 1 and len(writers.append_iteration(path, {"x": 2})) == 2
    write(tmp_path / "it.json", "broken")
    assert writers.append_iteration(path, {"x": 3}) == [{"x": 3}]
    files = spark.createDataFrame([("a.jpg", b"1")], "name string, content binary")
    kept = writers.image_files(files, str(tmp_path / "img")).collect()
    writers.image_files(files.withColumn("content", F.lit(b"2")), str(tmp_path / "img")).collect()
    assert open(kept[0].path, "rb").read() == b"1"
    assert writers.upload_format(str(tmp_path)) == "folder" and writers.upload_format("a.jsonl") == "json"
    with pytest.raises(ValueError):
        writers.upload_format("a.bin")
    assert readers.prompt(str(tmp_path), os.path.basename(write(tmp_path / "p.txt", "Hi {name}")), name="Bo") == "Hi Bo\n"


def test_datasets(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    write(tmp_path / "d.jsonl", '{"messages": [{"role": "user", "content": "x"}]}', '{"messages": []}')
    got, name = readers.dataset(spark, str(tmp_path / "d.jsonl"))
    assert got.count() == 2 and "messages" in got.columns and name.endswith("d.jsonl")
    df.write.parquet(str(tmp_path / "set" / "train"))
    df.write.json(str(tmp_path / "js"))
    assert readers.dataset(spark, str(tmp_path / "set"))[0].count() == 2 and readers.dataset(spark, str(tmp_path / "js"))[0].count() == 2
    with pytest.raises(ValueError):
        readers.dataset(spark, str(tmp_path / "gone"))


def test_decisions_are_strict(tmp_path):
    good = json.loads(decisions.FixedDecisions().complete(decisions.Request("decide_modality", "")))
    assert decisions.strict("decide_modality", good | {"confidence": 1})["confidence"] == 1.0
    for bad in ({**good, "x": 1}, {k: v for k, v in good.items() if k != "rationale"}, {**good, "modality": "sound"}, {**good, "confidence": "1"}, {**good, "confidence": True}):
        with pytest.raises(ValueError):
            decisions.strict("decide_modality", bad)

    class Stubborn(decisions.FixedDecisions):
        asked = 0

        def complete(self, request):
            self.asked += 1
            return json.dumps(json.loads(super().complete(request)) | {"trainer_key": "mine"})

    stubborn = Stubborn()
    d = decisions.Decider(stubborn, str(tmp_path), registry.default_registry().snapshot())
    assert d.components({}, "text")["trainer_key"] == "mine" and stubborn.asked == 2
    assert report.records(d.log)[0]["stage"] == "select_components"
    with pytest.raises(NotImplementedError):
        registry.default_registry().model_loaders["hf_vision_default"]()


def settings(tmp_path, **more):
    return {"country": "Nowhere", "sft_target_language": "en", "hf_model_id": "m", "run_dir": str(tmp_path / "run"), "max_steps": 100, **more}


def test_full_run(spark, tmp_path):
    out = Pipeline(spark, settings(tmp_path, max_queries=3, serper_top_results=2, collect_images=True)).run()
    shown = spark.read.json(str(tmp_path / "run" / "collect" / "images.json")).collect()
    assert len(shown) == 6 and all(r.img_url == "/a.jpg" and r.context_text_after.startswith(" after") and os.path.getsize(r.file_path) == 24 for r in shown)
    about = json.loads((tmp_path / "run" / "collect" / "metadata.json").read_text("utf-8"))
    assert about["num_images"] == 6 and about["num_samples"] == 6 and about["provider"] == "serper"
    assert datetime.fromisoformat(about["collected_at"]).tzinfo is not None
    assert spark.read.json(about["raw_result_path"]).count() == 6
    assert out["mode"] == "full" and out["sft"]["num_items"] == 6 and out["sft"]["num_examples"] == 36
    text = open(out["report_path"], encoding="utf-8").read()
    places = [text.index(f"## {s}") for s in ("Dataset Summary", "Agent Decisions", "Selected Components", "Training Iterations", "Failure Clusters", "Error Analysis")]
    assert places == sorted(places) and "### Iteration 0" in text


def test_agentic_run_searches_and_retries(spark, tmp_path):
    write(tmp_path / "d.jsonl", *(json.dumps({"messages": [{"role": "user", "content": f"q {i}"}, {"role": "assistant", "content": f"answer {i}"}]}) for i in range(6)))
    out = Pipeline(spark, settings(tmp_path, mode="agentic", data_path=str(tmp_path / "d.jsonl"), max_iters=3, search_trials=2), decider=decisions.FixedDecisions(1)).run()
    runs = readers.json_list(str(tmp_path / "run" / "iterations.json"))
    assert len(runs) == 2 and runs[1]["config"]["max_steps"] == runs[0]["config"]["max_steps"] + 50
    assert [r["stage"] for r in report.records(str(tmp_path / "run" / "agent_decisions.jsonl"))] == ["decide_modality", "select_components", "suggest_training_adjustments", "suggest_training_adjustments", "analyze_errors"]
    assert out["component_selection"]["hf_model_id"] == "m" and out["cluster_preview"]["clusters"]
    assert json.loads((tmp_path / "run" / "eval" / "cluster_preview.json").read_text("utf-8")) == out["cluster_preview"]


def test_guards(spark, tmp_path):
    for mode in ("workflow", "minimal_agentic"):
        with pytest.raises(ValueError, match="data_path"):
            Pipeline(spark, settings(tmp_path, mode=mode)).run()
    with pytest.raises(ValueError, match="unknown mode"):
        Pipeline(spark, settings(tmp_path, mode="odd")).run()
    with pytest.raises(ValueError):
        Pipeline(spark, {"country": "x"})
    assert cli.settings(["--data_path", "d", "--out_dir", "o", "--max_steps", "5"]) == {"data_path": "d", "run_dir": "o", "max_steps": 5, "mode": "workflow", "log_level": "WARN"}


def test_streamed_metrics(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    rows = [{"run": "a", "line_no": i, "step": 10 * i, "loss": 2.0 - i / 10, "eval_loss": 3.0 - i / 10 if i % 2 else None} for i in range(5)]
    write(folder / "1.json", *map(json.dumps, rows[:3]))
    for more in ([], rows[2:]):
        if more:
            write(folder / "2.json", *map(json.dumps, more))
        stream.start(spark, str(folder), str(tmp_path / "cp"), "folded").awaitTermination(60)
        got = spark.table("folded").first()
    assert (got.steps, got.best_eval_loss, got.last_train_loss, got.last_eval_loss) == (40, 2.7, 1.6, 2.7)


def test_ids_over_several_partitions(spark, tmp_path):
    run = Pipeline(spark, settings(tmp_path))
    texts = spark.createDataFrame([(10 * i, f"text {i}") for i in range(40)], "ord long, text string").repartition(5)
    run.examples(texts)
    items = spark.read.parquet(str(tmp_path / "run" / "sft" / "items")).collect()
    assert {r.item_id: r.text for r in items} == {f"line_{i + 1}": f"text {i}" for i in range(40)}
    run.examples(texts.drop("ord"))
    assert {r.item_id for r in spark.read.parquet(str(tmp_path / "run" / "sft" / "items")).collect()} == {f"line_{i + 1}" for i in range(40)}
    run.evaluation(texts.drop("ord"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "run" / "eval" / "predictions")).collect()) == list(range(40))


def test_annotation_mode_guard(spark, tmp_path):
    texts = spark.createDataFrame([(0, "a")], "ord long, text string")
    for mode, said in (("image", "examples_of_images"), ("sound", "unknown")):
        with pytest.raises(ValueError, match=said):
            Pipeline(spark, settings(tmp_path, sft_mode=mode)).examples(texts)


class Hub:
    def push(self, path, repo, kind, token):
        if kind == "adapter":
            raise OSError("no space")
        return f"{repo}:{token}"


def test_split_and_publishing(spark, tmp_path):
    for split, n in (("train", 5), ("test", 3)):
        spark.range(n).selectExpr(f"concat('{split} ', id) as text").write.parquet(str(tmp_path / "set" / split))
    more = {"mode": "workflow", "data_path": str(tmp_path / "set"), "eval_split": "test", "hf_dataset_repo": "d", "hf_adapter_repo": "o/a", "hf_username": "u", "hf_token": "t"}
    out = Pipeline(spark, settings(tmp_path, **more), hub=Hub()).run()
    assert sorted(r.input for r in readers.predictions(spark, out["predictions_path"]).collect()) == ["test 0", "test 1", "test 2"]
    assert out["hub"] == {"dataset_repo_id": "u/d:t", "adapter_error": "no space"}
    assert json.loads((tmp_path / "run" / "manifest.json").read_text("utf-8"))["sample_count"] == 5
    assert "hub" not in Pipeline(spark, settings(tmp_path, **more)).run()


def test_export_and_manifest(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "é")], "a int, b string").coalesce(1).write.parquet(str(tmp_path / "p"))
    writers.parquet_to_jsonl(spark, str(tmp_path / "p"), str(tmp_path / "j"))
    lines = [x for f in (tmp_path / "j").glob("part-*") for x in f.read_text("utf-8").splitlines()]
    assert sorted(lines) == ['{"a":1,"b":null}', '{"a":2,"b":"é"}']
    path = writers.manifest(str(tmp_path / "m" / "n"), {"é": [1]})
    assert path.endswith("manifest.json") and json.loads(open(path, encoding="utf-8").read()) == {"é": [1]}


def test_image_prompt(spark):
    rows = spark.createDataFrame([("Cats",), ("",), (None,)], "hint string").select(annotate.image_prompt("hint", "fr").alias("p")).collect()
    plain = annotate.IMAGE_TASK.format(language="fr")
    assert [r.p for r in rows] == [plain + "\nTopic: Cats", plain, plain]


def test_journal(tmp_path):
    journal = report.Journal(str(tmp_path / "r"), lr=1)
    journal.log({"loss": 2.0}, 1)
    journal.log({"loss": 1.0})
    journal.log_artifact("a.bin", "model")
    assert journal.metrics == [{"step": 1, "loss": 2.0}, {"step": None, "loss": 1.0}] and journal.artifacts == [{"path": "a.bin", "type": "model"}] and journal.config == {"lr": 1}
    text = open(journal.finalize(dataset_summary={"n": 3}, component_selection={}, iterations=[], cluster_preview={}, error_analysis={}), encoding="utf-8").read()
    assert '"n": 3' in text and text.startswith("# ")
