import os
import subprocess
import sys

import duckdb
import pytest

from tessera.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return None
    return int(v) if isinstance(v, float) and v == int(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    rows = [tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()]
    assert rows
    if name in catalogue.oracle_sql():
        want = duck.sql(catalogue.oracle_sql()[name])
        names = want.columns
        assert sorted(names) == sorted(got.columns)
        place = [names.index(c) for c in sorted(names)]
        assert sorted(map(repr, rows)) == sorted(repr(tuple(plain(r[i]) for i in place)) for r in want.fetchall())


def test_entry_point_holds_both_parts(spark):
    import __spark_entry__ as entry

    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert os.path.isdir(SF)


@pytest.mark.parametrize("blocked", ["tiktoken", "sentencepiece", "zstandard", "tessera.llm", "corpus_pipeline"])
def test_a_missing_library_leaves_the_other_queries(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True, check=True)
    n, pipeline = said.stdout.split()
    assert int(n) >= len(catalogue.queries()) and (blocked != "corpus_pipeline" or pipeline == "False")


def test_term_weights_and_places_have_no_hot_exchange(spark):
    plan = catalogue.queries()["tfidf_weights"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
    plan = catalogue.queries()["taxonomy_flatten"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "doc_id" not in "".join(x for x in plan.splitlines() if "Window" in x)


def test_scans_read_only_needed_columns(spark):
    plan = catalogue.queries()["text_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    top = catalogue.queries()["url_dedup_topn"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top and "html" not in top


def test_failure_clusters_take_all_failures_and_ten_starts(spark, monkeypatch):
    from tessera.operators import evaluate

    starts, made = [], evaluate.clustered
    monkeypatch.setattr(evaluate, "clustered", lambda features, n, n_init=10, seed=42: starts.append(n_init) or made(features, n, n_init, seed))
    got = sorted(r.id for r in catalogue.queries()["failure_clusters"](spark, SF).collect())
    want = evaluate.failures(catalogue._predictions(spark, SF))
    assert got == sorted(r.id for r in want.select("id").collect()) and starts == [10]
    assert len(got) > evaluate.failures(catalogue._predictions(spark, SF), False).count()


def test_html_contexts_read_references_as_their_sql_does(spark, tmp_path):
    from tessera.operators import html

    cut = ["a&amp", "a&am", "a&quo", "a&quot", "a&", "a&amp;amp", "a&amp;&amp", "a&copy", "a&copyx;", "a&middot b", "a&lt;b&gt", "a&#39;", "a&#39", "a&nbsp;", "a&&amp;&quot;&copy;&middot;", "a"]
    pages = [(i, "http://h/p/q", f"<html><title>{x}</title><script>&amp</script><p>{x}</p>{x}<p>{x} {x}</html>") for i, x in enumerate(cut)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.queries()["html_text_context"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(catalogue.oracle_sql()["html_text_context"])
    rows = sorted(tuple(r[c] for c in want.columns) for r in got.collect())
    assert rows == sorted(want.fetchall()) and len(rows) == 2 * len(cut)
    # The operator itself reads them as HTML does.
    assert html.read("<title>a&amp</title>&lt;b")[0] == "a& <b"
