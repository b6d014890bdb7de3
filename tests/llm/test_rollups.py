import pytest

from tilelake.llm.common import scratch_path
from tilelake.llm.rollups import TokenRollup, op10_token_rollups


def totals(r):
    return sorted((x.source or "", x.lang or "", x.version, x.n_docs, x.n_tokens) for x in r.totals().collect())


def test_changes_replays_and_compaction(spark):
    r = TokenRollup(spark, scratch_path(spark, "t"))
    schema = "op string, source string, lang string, version string, n_tokens long, old_version string, old_tokens long, d_docs int"
    one = spark.createDataFrame([("insert", "a", "en", "v1", 10, None, None, 7), ("insert", "a", "en", "v1", 5, None, None, 7), ("insert", None, "de", "v1", None, None, None, 7)], schema)
    two = spark.createDataFrame([("revise", "a", "en", "v2", 12, "v1", 10, 7), ("delete", None, "de", "v1", 0, None, None, 7)], schema)
    assert r.apply("b1", one) and not r.apply("b1", one)
    assert totals(r) == [("", "de", "v1", 1, 0), ("a", "en", "v1", 2, 15)]
    assert r.apply("b2", two)
    want = [("a", "en", "v1", 1, 5), ("a", "en", "v2", 1, 12)]
    assert totals(r) == want
    r.compact()
    assert totals(r) == want and not r.apply("b1", one) and totals(r) == want
    assert r.apply("b3", one.limit(0)) and totals(r) == want
    r.compact()
    assert totals(r) == want and not r.apply("b3", one)


def test_half_written_batch_is_redone(spark):
    r = TokenRollup(spark, scratch_path(spark, "t"))
    df = spark.createDataFrame([("insert", "a", "en", "v1", 10)], "op string, source string, lang string, version string, n_tokens long")
    df.selectExpr("source", "lang", "version", "1L d_docs", "99L d_tokens").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(r._folder("b1"))
    assert totals(r) == [] and r.apply("b1", df) and totals(r) == [("a", "en", "v1", 1, 10)]


def test_batch_committed_during_compaction_counts_once(spark, monkeypatch):
    r = TokenRollup(spark, scratch_path(spark, "t"))
    schema = "op string, source string, lang string, version string, n_tokens long"
    r.apply("b1", spark.createDataFrame([("insert", "a", "en", "v1", 10)], schema))
    whole = r._all

    def late(base, batches):
        out = whole(base, batches)
        r.apply("b2", spark.createDataFrame([("insert", "a", "en", "v1", 5)], schema))
        return out

    monkeypatch.setattr(r, "_all", late)
    r.compact()
    monkeypatch.setattr(r, "_all", whole)
    assert totals(r) == [("a", "en", "v1", 2, 15)] and r._batches() == ["b2"]
    r.compact()
    assert totals(r) == [("a", "en", "v1", 2, 15)] and not r.apply("b1", spark.createDataFrame([("insert", "a", "en", "v1", 10)], schema))


def test_second_writer_and_unknown_changes(spark):
    r = TokenRollup(spark, scratch_path(spark, "t"))
    schema = "op string, source string, lang string, version string, n_tokens long"
    one = spark.createDataFrame([("insert", "a", "en", "v1", 10)], schema)
    r.deltas(one).write.parquet(f"{r.path}/aside/x")
    assert r.apply("b1", one) and not r._rename(f"{r.path}/aside/x", r._folder("b1"))
    assert totals(r) == [("a", "en", "v1", 1, 10)]
    for op in ("upsert", None, "revise"):
        with pytest.raises(Exception, match="unknown change"):
            r.apply("b2", spark.createDataFrame([(op, "a", "en", "v1", 10)], schema))
    assert not r.committed("b2") and totals(r) == [("a", "en", "v1", 1, 10)]


def test_query_on_odd_tables(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(f"{tmp_path}/one/documents.parquet")
    odd_docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    got = op10_token_rollups(spark, f"{tmp_path}/one").collect()
    assert sum(r.n_docs for r in got) == odd_docs.where("doc_id % 7 <> 0").count()
    assert op10_token_rollups(spark, f"{tmp_path}/none").count() == 0
