import random

import numpy as np
import pytest

from millrace.llm import line_dedup as m
from millrace.llm.line_dedup import Limits, dedup_lines, line_sets, meeting, similar


def brute(docs):
    """docs: (id, text) in order; the text left of each."""
    seen, out = [], []
    for _, text in docs:
        if text is None:
            out.append(None)
            continue
        kept = []
        for line in text.split("\n"):
            words = frozenset(line.encode().lower().split())
            if not words:
                kept.append(line)
                continue
            hit = any(5 * len(words & s) >= 4 * len(words | s) for s in seen)
            seen.append(words)
            if not hit:
                kept.append(line)
        out.append("\n".join(kept))
    return out


def corpus(rnd, n_docs, vocab=300, near=0.5):
    words = [f"w{i}" for i in range(vocab)]
    pool, docs = [], []
    for d in range(n_docs):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            if pool and rnd.random() < near:
                line = list(rnd.choice(pool))
                for _ in range(rnd.randint(0, 3)):
                    if line:
                        line[rnd.randrange(len(line))] = rnd.choice(words)
            else:
                line = rnd.choices(words, k=rnd.randint(0, 30))
            pool.append(line)
            lines.append(" ".join(line))
        docs.append((d, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("limits", [Limits(), Limits(2, 1, 1, 5, 4000), Limits(4096, 1, 1, 7)])
def test_like_brute_force(spark, limits):
    """Limits reach the workers as arguments: the second has long lists only, the third many blocks."""
    docs = corpus(random.Random(5), 150) + [(500, None), (501, ""), (502, "\n\n"), (503, "A b\na B\nb  a"), (504, "x " * 30000)]
    base = random.Random(2).choices([f"z{i}" for i in range(99)], k=40)
    docs += [(600 + k, " ".join(base[: k % 40] + [f"q{k}"] + base[k % 40 + 1 :])) for k in range(90)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in dedup_lines(df, limits=limits).collect()}
    for (i, _), want in zip(docs, brute(docs)):
        assert got[i]["text"] == want, i


def test_repeated_null_ids_and_clashing_columns(spark):
    rows = [(1, "a b c", "u"), (1, "a b c", "u"), (None, "a b c", "v"), (2, "d e f\na b c", "w")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines string")
    got = sorted((r["doc_id"] or -1, r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(df).collect())
    assert got == [(-1, "a b c", 1, 0), (1, "", 1, 1), (1, "", 1, 1), (2, "d e f", 2, 1)]
    assert dedup_lines(df.limit(0)).count() == 0


def test_threshold():
    assert similar("a b c d", "a b c d e") and not similar("a b c d e", "a b c d f") and similar("A A b", "b a")


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_words_of_bytes():
    import pyarrow as pa

    from millrace.llm.bytewords import words

    texts = ["A b  a", "", None, "x\n\ny\tB ", " ", "Ünï ÜNÏ", "z" * 70 + " " + "z" * 70]
    w = words(pa.array(["skip this"] + texts).slice(1))
    plain = [(i, n, x) for i, t in enumerate(texts) for n, line in enumerate((t or "").split("\n")) for x in line.encode().lower().split()]
    assert w.text.tolist() == [i for i, _, _ in plain]
    assert w.line_number[w.line].tolist() == [n for _, n, _ in plain]
    by = {}
    for h, (_, _, x) in zip(w.hashes.tolist(), plain):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)


def test_limits_change_what_lists_do():
    """On a list longer than its limit every line is marked; within the limit, lines with more partners than they name."""
    from millrace.llm.packed import Packer

    def kinds(limits):
        p, n = Packer(m.POSTINGS, 1), 6
        word, row = np.full(n, 7, "<u4"), np.arange(n, dtype="<i8")
        columns = [word, row.astype("<u4"), np.full(n, 5, "<u8"), np.zeros(n, "<u8"), row, np.zeros(n, "<u4"), np.full(n, 9, "<u4"), np.zeros(n, "<u4")]
        blocks = [*p.add(np.zeros(n, np.uint64), *columns), *p.flush()]
        rows = [x for b in meeting(limits)(iter(blocks)) for x in b.to_pylist()]
        return [sum(x["kind"] == k for x in rows) for k in (1, 2)], sorted(x["line1"] for x in rows if x["kind"] == 2)

    assert kinds(m.Limits()) == ([1 + 2 + 3 + 3 + 3, 6], [0, 0, 0, 0, 1, 1])
    assert kinds(m.Limits(short_list=5, leaders=2)) == ([5 + 4, 6], [1] * 6)
    assert kinds(m.Limits(first=9)) == ([15, 0], [])


def test_sets_of_more_lines_than_a_key_holds(monkeypatch):
    import pyarrow as pa

    from millrace.llm.bytewords import words

    w = words(pa.array(["a b a\n\nc b\n" * 50, "b a"]))
    codes = (w.hashes & np.uint64(31)).astype(np.uint8)
    want = line_sets(w, codes)
    monkeypatch.setattr(m, "KEY_LINES", 10)
    for x, y in zip(want, line_sets(w, codes)):
        assert sorted(x.tolist()) == sorted(y.tolist())
    assert (want[1] == line_sets(w, codes)[1]).all() and (want[2] == line_sets(w, codes)[2]).all()


def test_oracle(spark):
    from millrace.llm.contract import ORACLES, QUERIES
    from tests.oracle import compare

    compare(QUERIES["op9_line_dedup"](spark, "/root/testdata/sf0.01"), ORACLES["op9_line_dedup"], "/root/testdata/sf0.01")
