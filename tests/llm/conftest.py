import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def sentence(rng, n, words=("stone", "River", "über", "ñandú", "lamp", "of", "the", "and", "Tree", "7", "cloud", "été")):
    return " ".join(rng.choice(words) + rng.choice(["", ",", ".", "", ""]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Null, empty, blank, one word, a very long text, exact and near copies, odd white space, special strings."""
    rng = random.Random(3)
    out = [None, "", " \n\t ", "word", "Two words", "a\x0bb\x0cc\x1cd e f", "x" * 50_000, "<|endoftext|> and <|endoftext|>s", "  lead and trail \n\n", "日本語 テキスト です 🙂" * 30]
    base = [sentence(rng, rng.choice([5, 12, 13, 14, 40, 200])) for _ in range(40)]
    out += base + base[:8] + [b + " tail end" for b in base[:10]] + [b.replace("the", "a", 1) for b in base[10:16]]
    out.append("\n".join(sentence(rng, 60) for _ in range(200)))
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Repeated rows, a null id, and further columns whose names operators use inside."""
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], "s", i) for i, t in enumerate(texts)]
    rows += [rows[3], rows[12], (None, texts[15], "en", "s", 0), (None, None, None, None, None)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumn("kept", F.lit("x")).withColumn("fp", F.lit("clash")).withColumn("fingerprint", F.lit(1)).withColumn("sequence_id", F.lit(2))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
