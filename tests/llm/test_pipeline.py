import public_tokenizers
import pytest

import corpus_pipeline as p
from tests.llm.test_line_dedup import brute as lines_left
from tests.llm.test_order_minhash import classes
from tests.llm.test_templates import brute as leaked

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(p.STAGES)[name]


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_like_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lib, total = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), docs.count()
    for name, f in p.STAGES:
        before = rows(docs)
        out = f(spark, docs, SF)
        if name != "encode":
            assert out.columns == p.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality":
            assert 0.6 * total < out.count() < total and set(rows(out)) < set(before)
        elif name == "line_dedup":
            left = zip(before, lines_left(before))
            assert rows(out) == [(i, t) for (i, b), t in left if t == b or t.strip()]
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "near_dedup":
            want = classes([t for _, t in before])
            assert rows(out) == [d for k, d in enumerate(before) if want[k] == k]
        elif name == "decontaminate":
            found = leaked(before, bench)
            assert rows(out) == [d for d in before if not found[d[0]]]
        else:
            assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in before}
        docs = out


@pytest.mark.parametrize("rows_", [[], [(1, None, "en", "s", None), (1, None, "en", "s", None), (2, "", "en", "s", 0), (None, "a b", "de", None, 3)]])
def test_odd_rows(spark, tmp_path, rows_):
    sf = tmp_path / "sf"
    spark.createDataFrame(rows_, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)][: len(rows_)], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "x y")][: len(rows_)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = p.run(spark, str(sf)).collect()
    assert len(got) <= len(rows_)
