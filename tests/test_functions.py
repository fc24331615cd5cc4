import json
import random
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import jsontext, order, validate
from tessera.functions import text as T
from tessera.operators import annotate

ODD = ["", " a ", "\x1c a\x85b  c　", "A  B\tC\nd", " x ", "İstanbul ÉTÉ", "\x0b\x0c", "a​b"]


def test_strip_and_normalise_are_python(spark):
    df = spark.createDataFrame([(s,) for s in ODD], "s string")
    for r in df.select("s", T.strip("s").alias("a"), T.normalise("s").alias("b"), T.tokens(T.normalise("s")).alias("c")).collect():
        assert (r.a, r.b, r.c) == (r.s.strip(), " ".join(r.s.lower().split()), r.s.lower().split())


@pytest.mark.parametrize("url", ["https://www.web.com/x", "http://wx.com", "https://m.facebook.com:443/a?b#c", "http://u:p@Host.Example.org/", "http://a_b.example.com/p q", "http://[::1]:80/x", "ex.com/p", "", "//cdn.example.net/x", "mailto:a@b.c", "https://notfacebook.com"])
def test_hosts(spark, url):
    got = spark.createDataFrame([(url,)], "u string").select(T.host("u").alias("h"), T.bare_host("u").alias("b")).first()
    want = urlparse(url).hostname
    assert got.h == want
    assert (got.b or "") == (want or "").lstrip("w.")


CASES = [
    ('{"a": 1}', {"a": 1}), (' [1, 2] ', [1, 2]), ('x ```json\n{"a": 1}\n``` y', {"a": 1}), ('```json\n{bad}\n```\n```\n{"b": 2}\n```', {"b": 2}),
    ('see {"a": {"b": 1}} end', {"a": {"b": 1}}), ('{x} then {"s": "}{"} {"t": 1, "u": 2}', {"t": 1, "u": 2}), ('t {"q": "a\\"}"} u', {"q": 'a"}'}),
]


@pytest.mark.parametrize("text, want", CASES)
def test_json_in_prose(text, want):
    assert jsontext.extract_json(text) == want


def test_json_absent(spark):
    with pytest.raises(ValueError):
        jsontext.extract_json("no {braces here")
    df = spark.createDataFrame([(t,) for t, _ in CASES] + [("none {",), (None,)], "t string")
    got = [r[0] for r in df.select(jsontext.json_in(F.col("t"))).collect()]
    assert [json.loads(g) if g else None for g in got] == [w for _, w in CASES] + [None, None]


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=6), lambda c: st.dictionaries(st.text(max_size=4), c, max_size=3), max_leaves=8).filter(lambda v: isinstance(v, dict)), st.text("ab \n", max_size=8))
def test_json_survives_prose(value, prose):
    assert jsontext.extract_json(prose + json.dumps(value) + prose) == value


def good_text():
    return {
        "knowledge_qa": [{"question": "q", "answer": "a"}] * 3,
        "detailed_explanation": {"instruction": "i", "response": "r"}, "analytical_reasoning": {"instruction": "i", "response": "r"},
        "conversational_exchange": {"opening_question": "a", "opening_response": "b", "follow_up_question": "c", "follow_up_response": "d"},
        "metadata": {"language": "en", "topics": ["t"], "domain": "x"}, "extra": 1,
    }


def good_image():
    return {
        "info": {
            "content_properties": {"quality": "High", "primary_subject": "Food", "object_count": "5", "human_presence": "None", "face_visibility": "Not Applicable"},
            "text_properties": {"contains_text": "yes", "is_suitable_for_ocr": 0, "text_type": "Printed"},
            "task_suitability": {"is_suitable_for_counting": True, "is_suitable_for_reasoning": "off", "is_suitable_for_multi_step_instruction": False},
        },
        "caption": {"text": "c"}, "vqa": [{"question": "q", "answer": "a"}] * 7, "ocr": {}, "reason": {"instruction": "i", "answer": "a"}, "instruct_follow": {"instruction": "i", "answer": "a"},
    }


def test_validation_coerces_and_drops():
    out = validate.validated(validate.TEXT_ANNOTATION, good_text())
    assert "extra" not in out
    image = validate.validated(validate.IMAGE_ANNOTATION, good_image())
    assert image["info"]["content_properties"]["object_count"] == 5
    assert image["info"]["text_properties"] == {"contains_text": True, "is_suitable_for_ocr": False, "text_type": "Printed"}
    assert image["ocr"] == {"instruction": None, "answer": None}


def test_validation_rejects():
    for change in (
        lambda d: d.update(knowledge_qa=d["knowledge_qa"][:2]), lambda d: d.update(knowledge_qa=d["knowledge_qa"] * 3), lambda d: d["metadata"].update(domain=""),
        lambda d: d["metadata"].update(topics=[]), lambda d: d["metadata"].update(language=5), lambda d: d.pop("detailed_explanation"),
    ):
        bad = good_text()
        change(bad)
        with pytest.raises(validate.Invalid):
            validate.validated(validate.TEXT_ANNOTATION, bad)
    spaced = good_text()
    spaced["metadata"]["domain"] = " "
    validate.validated(validate.TEXT_ANNOTATION, spaced)
    for n in (5.5, -1, "x", None):
        bad = good_image()
        bad["info"]["content_properties"]["object_count"] = n
        with pytest.raises(validate.Invalid):
            validate.validated(validate.IMAGE_ANNOTATION, bad)
    bad = good_image()
    bad["info"]["content_properties"]["quality"] = "great"
    with pytest.raises(validate.Invalid):
        validate.validated(validate.IMAGE_ANNOTATION, bad)
    with pytest.raises(validate.Invalid):
        validate.validated(validate.TEXT_ANNOTATION, [1])


def test_checked_column(spark):
    rows = [(json.dumps(good_text()),), ("{}",), ("not json",), (None,)]
    got = spark.createDataFrame(rows, "j string").select(annotate.checked(F.col("j"), validate.TEXT_ANNOTATION).alias("c")).select("c.*").collect()
    assert [r.valid for r in got] == [True, False, False, False]
    assert got[1].error == "schema: knowledge_qa: missing"


def test_ordinals(spark):
    rng = random.Random(1)
    values = [rng.randrange(1000) for _ in range(500)]
    got = order.ordinal(spark.createDataFrame([(v,) for v in values], "v int").repartition(7), "v").collect()
    assert sorted(r.ordinal for r in got) == list(range(1, 501))
    assert [r.v for r in sorted(got, key=lambda r: r.ordinal)] == sorted(values)
    assert order.ordinal(spark.createDataFrame([], "v int"), "v").count() == 0
