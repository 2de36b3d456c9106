import zlib

import numpy as np
import pytest

from millrace.llm.quality_gam import FEATURES, Model, classify, features, fit, keep_good, shallow_tree, train


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in classify(docs, labels).collect()}
    assert len(got) == docs.count()
    rows = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    held = [(r["score"], q) for r, q in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r, _ in rows)
    s, y = np.array(held).T
    assert auc(y, s) > 0.97 and ((s >= 0.3) == (y == 1)).mean() > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got.values())


def test_interaction_is_learned():
    rnd = np.random.default_rng(1)
    x = rnd.random((4000, len(FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    m = fit(x, y)
    assert (2, 7) in m.pairs or (7, 2) in m.pairs
    assert auc(y, m.score(x)) > 0.95


def test_tree_finds_the_step():
    g = np.r_[np.full(10, -1.0), np.full(6, 3.0)]
    v = shallow_tree(g, np.ones(16), leaves=2, ridge=0)
    assert (v[:10] == -1).all() and (v[10:] == 3).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (None, "x " * 200000, 9.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == 4 and all(r["score"] == pytest.approx(0.5) for r in got)
    assert classify(docs.limit(0), labels).count() == 0
    assert len(features("")) == len(FEATURES) and np.isfinite(features("\ud800 \x00")).all()
    assert isinstance(train(docs, labels), Model)


def test_scores_like_plain_lookups(spark):
    """Every text's score from the model's tables by plain Python: one bisection and one entry per feature and pair."""
    from bisect import bisect_left
    from math import exp

    from millrace.llm import quality_gam as m

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = m.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in m.classify(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        x, z = m.features(t or ""), model.base
        for k, (edges, table) in enumerate(zip(model.edges, model.tables)):
            z += table[bisect_left(edges.tolist(), x[k])]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            z += table[bisect_left(model.coarse[a].tolist(), x[a]) * m.PAIR_BINS + bisect_left(model.coarse[b].tolist(), x[b])]
        assert abs(got[i] - 1 / (1 + exp(-z))) < 1e-9


def test_features_like_plain_counts():
    from millrace.llm.quality_gam import FEATURES, features

    f = dict(zip(FEATURES, features("Aa bb bb!\nCc 12 |\nAa bb bb!")))
    assert (round(np.expm1(f["log_words"])), f["mean_word"], f["distinct_share"], f["repeat_share"]) == (9, 19 / 9, 6 / 9, 0.0)
    assert (f["distinct_lines"], f["bang_share"], f["bar_share"], f["title_share"], f["mean_line"]) == (2 / 3, 2 / 9, 1 / 9, 3 / 9, 3.0)
