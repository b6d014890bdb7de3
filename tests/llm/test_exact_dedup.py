import hashlib
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import maybe_in
from tilelake.llm.exact_dedup import DigestIndex, drop_exact_copies, exact_dedup


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for d, t in rows:
        same = [(i, x) for i, x in rows if norm(x) == norm(t)]
        keep = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out.append((d, keep, len(same), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("key_bytes", [32, 1])
def test_against_brute_force(spark, odd_docs, key_bytes):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact_dedup(odd_docs, key_bytes=key_bytes).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_shortened_digests_are_split_by_text(spark):
    rows = [(i, f"text {i % 400}") for i in range(1000)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), key_bytes=1).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_empty_table_and_null_ids(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = exact_dedup(spark.createDataFrame([(None, "a b"), (3, "ab")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(None, None, True), (3, None, False)}


def test_stage_keeps_columns(spark, odd_docs):
    out = drop_exact_copies(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 5, 6, 7, 8, 8, 9, 10]


def test_filters_leave_only_shared_digests_to_merge(spark):
    rows = [(i, f"text {i % 700}" if i < 900 else f"single {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = DigestIndex(spark)
    for part in range(3):  # three batches, each with runs of its own
        index.append(docs.where(f"doc_id % 3 = {part}"), 2)
    shared = index.shared_bits()
    runs = reduce(DataFrame.unionByName, index.runs)
    many = maybe_in(runs, F.col("digest"), shared, index.log2, "many").where("many").count()
    in_two = runs.groupBy("digest").count().where("count > 1").count()
    assert in_two > 100 and many < 3 * in_two < runs.count() / 2
    got = sorted((r.keep_id, r.n) for r in index.compact().collect())
    best = {}
    for i, t in rows:
        best.setdefault(t, []).append(i)
    assert got == sorted((min(v), len(v)) for v in best.values())
    index.drop()
