import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import validate
from tessera.operators import annotate, sft, taxonomy
from tessera.sources import connectors
from tests.test_functions import good_image, good_text


class Scripted(connectors.FixedAnnotator):
    def complete(self, request):
        if request.user_message.endswith("Topic B"):
            raise OSError("down")
        return super().complete(request)


def test_taxonomy_tables(spark):
    with pytest.raises(ValueError, match="required"):
        taxonomy.categories(spark, " ", connectors.FixedAnnotator())
    cats = taxonomy.categories(spark, "Nowhere", connectors.FixedAnnotator()).persist()
    assert [(r.cat_ord, r.name) for r in cats.orderBy("cat_ord").collect()] == [(0, "Topic A"), (1, "Topic B")]
    subs = taxonomy.subcategories(cats.where("name = 'Topic A'"), "Nowhere", connectors.FixedAnnotator()).persist()
    assert [r.name for r in subs.orderBy("sub_ord").collect()] == ["A Topic A 1", "A Topic A 2"]
    broken = taxonomy.subcategories(cats, "Nowhere", Scripted(), retry_delay=0.0).where("category = 'Topic B'").collect()
    assert [(r.sub_ord, r.name) for r in broken] == [(None, None)]
    twice = subs.unionByName(subs.withColumn("sub_ord", F.col("sub_ord") + 10))
    q = taxonomy.queries(twice, "Nowhere", connectors.FixedAnnotator()).persist()
    assert q.count() == 4 and q.agg(F.min("sub_ord")).first()[0] == 10
    flat = taxonomy.flattened(q, 3).collect()
    assert len(flat) == 3 and [r.q_ord for r in flat][:2] == [0, 1]
    assert taxonomy.flattened(q, 0).count() == 4
    totals = {r.category: (r.n_subcategories, r.n_queries) for r in taxonomy.counts(q).collect()}
    assert totals == {"Topic A": (2, 4), None: (2, 4)}
    c, s, k = taxonomy.trimmed(cats, subs, q, 0)
    assert (c.count(), s.count(), k.count()) == (0, 0, 0)
    with pytest.raises(RuntimeError):
        taxonomy.required(q.limit(0))


@pytest.mark.parametrize("payload, want", [
    ('{"search_queries": ["a", "", null, 3, "b"]}', ["a", "b"]), ('{"search_queries": [], "keywords": ["k"]}', ["k"]),
    ('{"keywords": [{"query": "q"}, {"keyword": "w"}, "s", {"query": ""}]}', ["q", "w"]), ("{}", []), ("junk", []), ('{"search_queries": "text"}', []),
])
def test_query_payloads(spark, payload, want):
    assert spark.createDataFrame([(payload,)], "p string").select(taxonomy.query_list(F.col("p"))).first()[0] == want


def test_annotation_isolates_failures(spark):
    calls = []

    class Picky:
        def complete(self, request):
            if "bad" in request.user_message:
                return "no json"
            return "```json\n" + json.dumps(good_text() if "good" in request.user_message else {"x": 1}) + "\n```"

    items = spark.createDataFrame([("1", "good"), ("2", "bad"), ("3", "other"), ("4", "good two")], "item_id string, text string")
    notes = annotate.annotate_texts(items, Picky(), "en", retry_delay=0.0).persist()
    got = {r.id: (r.success, r.error) for r in notes.collect()}
    assert got["1"] == got["4"] == (True, None) and not got["2"][0] and got["3"] == (False, "schema: knowledge_qa: missing")
    made = sft.text_sft(notes)
    assert made.count() == 12
    assert annotate.stats(items, notes, made) == {"num_items": 4, "num_annotations": 2, "num_examples": 12, "num_failures": 2}
    assert sorted(r.item_id for r in annotate.failed_items(items, notes).collect()) == ["2", "3"]
    assert [len(json.loads(r.examples)) for r in sft.serialised(made).collect()] == [6, 6]
    last = made.where("id = '1'").orderBy(F.desc("ex_ord")).first()
    assert [m.role for m in last.messages] == ["user", "assistant"] * 2 and last.ex_ord == 5
    assert made.where(~sft.well_formed(F.col("messages"))).count() == 0 and not calls


def test_image_examples(spark):
    full, half = good_image(), good_image()
    full["ocr"] = {"instruction": "read", "answer": "X"}
    half["ocr"] = {"instruction": "read", "answer": ""}
    rows = [("a", True, json.dumps(full)), ("b", True, json.dumps(half)), ("c", False, None), ("d", True, json.dumps(full))]
    notes = spark.createDataFrame(rows, "id string, success boolean, data string")
    items = spark.createDataFrame([("a", "old.jpg"), ("b", "b.jpg"), ("a", "new.jpg")], "item_id string, image_path string").coalesce(1)
    got = sft.image_sft(notes, items).collect()
    assert len(got) == 11 + 10
    assert {r.messages[0].content[1].image for r in got if r.id == "a"} == {"new.jpg"}
    first = next(r for r in got if r.id == "a" and r.ex_ord == 0)
    assert first.messages[0].content[0].text == sft.CAPTION and first.messages[1].content[0].text == "c"


def test_well_formed(spark):
    rows = [([("user", "a"), ("assistant", "b")], True), ([("user", "a")], False), ([], False), ([("assistant", "a"), ("user", "b")], False), ([("user", ""), ("assistant", "b")], False), ([("user", None), ("assistant", "b")], False)]
    df = spark.createDataFrame([(m,) for m, _ in rows], "messages array<struct<role string, content string>>")
    assert [r[0] for r in df.select(sft.well_formed(F.col("messages"))).collect()] == [w for _, w in rows]


def test_retries():
    waits, tries = [], []

    def fail(error):
        def call():
            tries.append(1)
            raise error

        return call

    for error, n, slept in ((ValueError(), 3, [2.0, 4.0]), (connectors.StatusError(404), 1, []), (connectors.StatusError(429, "9"), 3, [9.0, 9.0]), (connectors.StatusError(429, "x"), 3, [5.0, 5.0]), (connectors.StatusError(500), 3, [2.0, 4.0])):
        waits.clear(), tries.clear()
        with pytest.raises(type(error)):
            connectors.persistent(fail(error), sleep=waits.append)
        assert (len(tries), waits) == (n, slept)


def test_payloads(tmp_path):
    picture = tmp_path / "a.png"
    picture.write_bytes(b"x")
    r = connectors.Request("1", "hi", "sys", (str(picture),), {"top_p": 1})
    chat = connectors.chat_payload(r, "m")
    assert chat["messages"][0]["role"] == "system" and chat["messages"][1]["content"][1]["image_url"]["url"] == "data:image/png;base64,eA==" and chat["top_p"] == 1
    parts = connectors.parts_payload(r)
    assert parts["contents"][0]["parts"][1]["inline_data"] == {"mime_type": "image/png", "data": "eA=="} and parts["generationConfig"]["top_p"] == 1
    assert connectors.chat_text({"choices": [{"message": {"content": "t"}}]}) == "t"
    assert connectors.parts_text({"candidates": [{"content": {"parts": [{"text": "a"}, {"text": "b"}]}}]}) == "ab"
    assert validate.flag("YES", "x") is True
