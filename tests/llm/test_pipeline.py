import os
from collections import defaultdict

import pytest

from tilelake.llm.exact_dedup import exact_dedup
from tilelake.llm.jaccard import jaccard_components
from tilelake.llm.quality import classify

DIR = "/root/testdata/sf0.001"


def test_stages_against_their_operators(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    now, out = docs, {}
    for name, stage in p.STAGES:
        out[name] = spark.createDataFrame(stage(spark, now, DIR).collect(), docs.schema if name != "pack" else None)
        if name != "pack":
            assert out[name].columns == docs.columns
        now = out[name]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(out["quality"]) == ids(classify(docs).where("accepted"))
    assert ids(out["exact"]) == ids(exact_dedup(out["quality"]).where("kept"))
    assert ids(out["near"]) == ids(jaccard_components(out["exact"]).where("doc_id = component_id"))
    assert set(ids(out["mix"])) <= set(ids(out["near"])) and len(ids(out["mix"])) > 0.4 * len(ids(out["near"]))
    assert {r.doc_id for r in now.collect()} == set(ids(out["mix"]))
    seqs = defaultdict(int)
    for r in now.collect():
        seqs[r.sequence_id] += r.length
    assert max(seqs.values()) <= 2048
    assert sorted(map(repr, p.run(spark, DIR).drop("sequence_id", "offset").collect())) == sorted(map(repr, now.drop("sequence_id", "offset").collect()))


@pytest.mark.skipif(not os.path.exists("corpus_pipeline.py"), reason="run from the top of the repository")
def test_registered(spark):
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
