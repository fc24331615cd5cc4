import random
import re
import textwrap

from tessera.llm import licenses

LOW = str.maketrans(licenses._UPPER, licenses._LOWER)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain(rows):
    out = []
    for d, t in rows:
        w = words_of(t)
        places = [(i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        own, part = set(), 0.0
        lines = [x for x in map(words_of, (t or "").split("\n")) if x]
        for i in range(len(lines)):
            for label, text in licenses.TEMPLATES:
                want, have, n = set(words_of(text)), set(), 0
                for line in lines[i:]:
                    have, n = have | set(line), n + len(line)
                    if n >= len(words_of(text)):
                        break
                if 1000 * len(have & want) >= 800 * len(want):
                    own.add(label)
                    part = max(part, len(have & want) / len(want))
        base = {x for _, x in places}
        at = [i for i, _ in places]
        out.append((str(d), len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if places else part))
    return sorted(out, key=str)


def result(df):
    return sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in df.collect()), key=str)


def test_rows_match_brute_force(spark, docs, empty):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    extra = ["MIT License MIT License, mit-license", "xmit license", "cc\nby", "CC.BY cc by", "éMIT License", "GNU General Public  License apache LICENSE", "permit license", "mİt license", "Kcc by", "gnu general public"]
    for label, t in licenses.TEMPLATES:
        w = t.split()
        for drop in (0, 1, 2, 3, 5, 8):
            keep = rng.sample(w, max(0, len(w) - drop))
            extra.append("First line.\n" + " ".join(keep + rng.choices(["stone", "tree", "lamp"], k=drop)) + "\nlast line")
    rows2 = rows + [(1000 + i, t) for i, t in enumerate(extra)] + [(1000, extra[0])]
    df = spark.createDataFrame(rows2, "doc_id long, text string").repartition(3)
    assert result(licenses.scan(spark, df)) == plain(rows2)
    assert result(licenses.scan(spark, docs)) == plain(rows)
    assert licenses.scan(spark, empty).count() == 0
    bare = licenses.scan(spark, df, templates=())
    assert all(r.labels == r.base_labels for r in bare.collect())


def test_no_python_on_the_main_path(spark, docs):
    plan = licenses.scan(spark, docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_wrapped_notices_get_their_labels(spark):
    """Every template in one line, wrapped at 76 columns and at ten words a line, commented, and with blank lines."""
    rows = []
    for label, t in licenses.TEMPLATES:
        w = t.split()
        tens = [" ".join(w[i : i + 10]) for i in range(0, len(w), 10)]
        for body in (t, textwrap.fill(t, 76), "\n".join(tens), "\n".join("# " + x for x in tens), "\n\n".join(tens)):
            rows.append((len(rows), "Some words before.\n" + body + "\nAnd some after.", label))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in licenses.scan(spark, df, phrases=()).collect()}
    assert all(label in got[d].labels.split(",") and got[d].score == 1.0 for d, _, label in rows)
    assert result(licenses.scan(spark, df)) == plain([r[:2] for r in rows])
    # The words of a notice that are spread over a long text are no notice.
    rng = random.Random(2)
    w = sorted({x for _, t in licenses.TEMPLATES for x in words_of(t)})
    spread = "\n".join(" ".join([x] + rng.choices(["stone", "tree", "lamp"], k=12)) for x in rng.sample(w, len(w)))
    assert [r.labels for r in licenses.scan(spark, spark.createDataFrame([(1, spread)], "doc_id long, text string"), phrases=()).collect()] == [""]
