import pytest

from tessera.llm import common


class Session:
    """As much of a session as the shared folder is asked of."""

    def __init__(self, spark, master, named, checkpoint=None):
        real = spark.sparkContext

        class Context:
            _jvm, _jsc = real._jvm, real._jsc

            def getCheckpointDir(self):
                return checkpoint

        class Conf:
            def get(self, key, default):
                return named or default

        self.sparkContext, self.conf = Context(), Conf()
        self.sparkContext.master = master


def test_shared_folder(spark, tmp_path):
    assert common.shared_dir(Session(spark, "yarn", str(tmp_path))) == f"file:{tmp_path}"
    assert common.shared_dir(Session(spark, "yarn", None, f"file:{tmp_path}/x/")) == f"file:{tmp_path}/x"
    assert common.shared_dir(Session(spark, "local[2]", None)).startswith("file:/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session(spark, "spark://host:7077", None))
    for named in ("dbfs:/x", "ofs://host/x"):
        with pytest.raises(ValueError, match="cannot open"):
            common.shared_dir(Session(spark, "yarn", named))
    assert common.shared_dir(Session(spark, "yarn", "s3a://bucket/x")) == "s3a://bucket/x"


def test_every_scheme_is_mapped_or_refused():
    assert common.located_uri("file:/a/b") == common.located_uri("file:///a/b") == "file:///a/b"
    assert common.located_uri("s3a://bucket/a") == "s3://bucket/a"
    assert common.located_uri("hdfs://host:9000/a") == "hdfs://host:9000/a" and common.located_uri("viewfs://c/a") == "viewfs://c/a"
    for uri in ("/a/b", "relative", "dbfs:/a"):
        with pytest.raises(ValueError, match="cannot open"):
            common.located_uri(uri)


def test_files_and_blocks(spark, tmp_path, docs, monkeypatch):
    common.put(f"file:{tmp_path}/a/b", b"x")
    assert common.get(f"file:{tmp_path}/a/b").to_pybytes() == b"x"
    monkeypatch.setattr(common, "BLOCK_BYTES", 500)
    monkeypatch.setattr(common, "BLOCK_ROWS", 7)
    table = docs.select("doc_id", "text").toArrow()
    parts = list(common.block_tables(table.to_batches(), "text"))
    assert sum(t.num_rows for t in parts) == table.num_rows and max(t.num_rows for t in parts) <= 7 and len(parts) > 5
    folder = common.scratch(spark, "test")
    rows = common.in_blocks(spark, docs, folder, "text", "doc_id", [], lambda b: [])
    everything = lambda df: sorted(map(repr, df.collect()))
    assert everything(common.from_blocks(rows, rows, folder, docs.schema)) == everything(docs)
    assert common.from_blocks(rows, rows.where("at < 0"), folder, docs.schema).count() == 0
