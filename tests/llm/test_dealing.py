import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import order_minhash
from millrace.llm.line_dedup import Limits, dedup_lines, rarity
from millrace.llm.order_minhash import near_duplicates
from millrace.llm.packed import deal


@pytest.mark.parametrize("blocks,rests", [(1, 1), (10, 1), (7, 3)])
def test_every_special_row_meets_every_row_once(spark, blocks, rests):
    rows = spark.range(400).selectExpr("id AS row", "id % 40 = 7 AS special", f"{blocks} AS blocks", f"{rests} AS rests")
    tasks = {}
    for r in deal(rows, ["row"], "blocks", "rests", F.col("special")).collect():
        tasks.setdefault((r["b1"], r["b2"]), []).append((r["row"], r["side"]))
    assert len(tasks) == blocks * rests
    met = [(y, x) for t in tasks.values() for y, s in t if s > 0 for x, z in t if z != 1]
    assert sorted(met) == [(y, x) for y in range(7, 400, 40) for x in range(400)]


def test_one_stranger_among_many_copies_costs_its_share(spark):
    """A hundred thousand rows and one open one: they are dealt once, not once per block."""
    rows = spark.range(100_000).selectExpr("id AS row", "id = 5 AS open", "49 AS blocks", "1 AS opens")
    dealt = deal(rows, ["row"], "blocks", "opens", F.col("open"))
    assert dealt.count() == 100_000 + 49
    largest = dealt.groupBy("b1", "b2").count().agg(F.max("count")).first()[0]
    assert largest < 1.2 * 100_000 / 49


def test_hot_list_with_one_open_line(spark):
    """Near copies of one line, and a stranger on the same lists: the result is that of all pairs, with blocks of a few lines."""
    base = [f"w{i}" for i in range(20)]
    lines = [" ".join(base[:i % 20] + [f"x{i % 7}"] + base[i % 20 + 1 :]) for i in range(300)]
    lines += ["common " + " ".join(f"s{i}" for i in range(9)), " ".join([*base[:9], *(f"y{i}" for i in range(11))])] + ["common other words here now"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id bigint, text string").repartition(4)
    sets, gone = [set(t.split()) for t in lines], set()
    for j, b in enumerate(sets):
        if any(5 * len(a & b) >= 4 * len(a | b) for a in sets[:j]):
            gone.add(j)
    got = {r["doc_id"] for r in dedup_lines(docs, limits=Limits(short_list=4, first=1, leaders=1, block=16)).where("n_removed > 0").collect()}
    assert got == gone and len(gone) > 250


def test_bucket_of_copies_with_strangers(spark, monkeypatch):
    """A bucket whose largest class has most rows: the others still meet each other and all of it."""
    monkeypatch.setattr(order_minhash, "BLOCK", 8)
    monkeypatch.setattr(order_minhash, "ROUNDS", 1)
    rng = np.random.default_rng(3)
    shared = [f"p{i}" for i in range(60)]
    texts = [" ".join([*shared, *[f"t{i}" if rng.random() > 0.03 else f"z{k}{i}" for i in range(140)]]) for k in range(60)]
    for g in range(4):  # strangers that share the passage only, in pairs that are near copies
        own = [f"g{g}v{i}" for i in range(140)]
        texts += [" ".join([*shared, *own]), " ".join([*shared, *own[:-2], "end", "here"])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    classes = {}
    for r in near_duplicates(docs).collect():
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, classes.values())) == [list(range(60)), *[[60 + 2 * g, 61 + 2 * g] for g in range(4)]]


def test_rarity_tells_large_counts_apart():
    counts = np.array([0, 1, 2, 55_000, 10**6, 10**9, 10**12, 10**15])
    codes = rarity(counts)
    assert (np.diff(codes.astype(int)) > 0).all() and codes[-1] < 255
