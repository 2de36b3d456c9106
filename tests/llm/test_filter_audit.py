import re
from collections import Counter
from itertools import permutations

import numpy as np

from millrace.llm.filter_audit import LETTERS, MASKS, ORDERS, Filters, audit, mask_histograms, outcome_matrices


def failures(i, text, everything):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": any(c in text for c in "#$%&*|"),
        "E": i is not None and any(j is not None and j < i and t == text for j, t in everything),
    }


def brute(docs, labels):
    """Every order applied to every document, one after the other."""
    everything = [(i, t or "") for i, t, _ in docs]
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    judged = [(i, lang or "", failures(i, t or "", everything)) for i, t, lang in docs]
    out, shapley = {}, Counter()
    for order in map("".join, permutations(LETTERS)):
        for part in {p for _, p, _ in judged}:
            left = [(i, f) for i, p, f in judged if p == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                removed = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                fails = [f for _, f in everyone if f[letter]]
                gone = sum(any(f[x] for x in order[: step - 1]) for f in fails)
                unique = sum(sum(f.values()) == 1 for f in fails)
                shapley[part, letter] += len(removed)
                out[part, order, step] = [len(left), len(removed), gone, unique, sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


LONG = " ".join(f"w{i}" for i in range(300))
DOCS = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG + " #", "en"), (4, "word " * 300, "en"), (5, None, None), (6, "", "en"), (7, "A B C", ""), (None, LONG, "en"), (None, LONG, "en"),
    (3, LONG + " #", "en"), (3, LONG, "fr"), (8, "é" * 40 + "A", "fr"), (9, "x\x0by\x0cz a b", "fr"), (10, "x" * 3_000_000, "en"), (11, "Ab " * 700_000, "en"), (12, "Ab " * 700_000, "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, None), (4, None, None), (6, 1, 0), (12, 1, 1), (None, 1, 1), (99, 1, 1)]


def test_like_filters_applied_one_by_one(spark):
    docs = spark.createDataFrame([(*d, "clash", 0) for d in DOCS], "doc_id bigint, text string, lang string, mask string, n int").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    got = found(audit(mask_histograms(docs, labels)))
    assert got == brute(DOCS, LABELS)
    assert len(got) == 600 * 4  # parts "", de, en, fr


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(DOCS[:2], "doc_id bigint, text string, lang string")
    assert audit(mask_histograms(docs.limit(0), labels)).count() == 0
    got = found(audit(mask_histograms(docs, labels)))
    assert len(got) == 1200 and all(v[4] == v[5] == 0 for v in got.values())


def test_matrices_share_out_every_mask():
    m = outcome_matrices()
    assert all(x.shape == (MASKS, 600) for x in m.values())
    # at each step a document is kept, removed here, or was removed before
    gone = np.cumsum(m["removed"].reshape(MASKS, len(ORDERS), 5), axis=2).reshape(MASKS, 600)
    assert (m["kept"] + gone == 1).all()


def test_hot_copies_and_many_parts(spark):
    """A third of the rows are one text, and there are more parts than are multiplied at once."""
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}", f"p{i % 150}") for i in range(3000)]
    got = found(audit(mask_histograms(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))))
    assert len(got) == 150 * 600
    assert sum(v[1] for (_, o, s), v in got.items() if o == "EABCD" and s == 1) == 999


def test_thresholds_are_settings():
    assert Filters().mask(b"") == 1 and Filters(min_words=0).mask(b"") == 0
    assert Filters(min_words=2, symbols="!").mask(b"a! a!") == 8 and Filters(min_words=2, min_distinct_percent=60).mask(b"a a") == 2
