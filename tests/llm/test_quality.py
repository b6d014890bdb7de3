import numpy as np

from tilelake.llm.quality import ABSTAIN, BAD, GOOD, WeakLabels, classify, describe, drop_rejected, fit


def test_em_recovers_accuracies():
    rng = np.random.default_rng(3)
    y = rng.random(20000) < 0.8
    acc = np.array([0.95, 0.9, 0.7, 0.85, 0.8, 0.9, 0.75, 0.88, 0.85])
    votes = np.where(rng.random((20000, 9)) < acc, y[:, None], ~y[:, None]).astype(int)
    votes[rng.random((20000, 9)) < 0.3] = ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = WeakLabels().fit(patterns, counts.astype(float))
    assert np.abs(np.array(list(m.accuracies().values())) - acc).max() < 0.03
    assert ((m.posterior(votes) > 0.5) == y).mean() > 0.96
    assert {GOOD, BAD} == {0, 1}


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs).join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(not r.accepted for r in bad) >= 0.9 * len(bad)
    assert sum(r.accepted for r in good) >= 0.995 * len(good)


def test_odd_tables(spark, odd_docs):
    got = classify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.accepted for r in got if r.doc_id in (3, 4, 5))
    assert classify(odd_docs.limit(0)).count() == 0
    assert fit(describe(odd_docs.limit(0))).b == 0.0
    assert drop_rejected(odd_docs).columns == odd_docs.columns
