from __future__ import annotations

import corpus_pipeline
from tests.llm.test_ops import DOCS, corpus, jaccard_by_force

from clickledger.llm import mixing, quality


def test_stages(spark):
    rows = corpus(60, 9)
    docs = spark.createDataFrame(rows, DOCS)
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    good = stage["quality_rules"](spark, docs, "").cache()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in quality.judge(docs).collect() if r["kept"]}
    lines = stage["line_dedup"](spark, good, "").cache()
    assert lines.columns == docs.columns and lines.count() == good.count()
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    alone = stage["ngram_jaccard_join"](spark, lines, "").cache()
    left = sorted((r["doc_id"], r["text"]) for r in lines.collect())
    _, tree = jaccard_by_force(left, 5, 80)
    assert sorted(r["doc_id"] for r in alone.collect()) == [left[i][0] for i in range(len(left)) if tree[i] == i]
    mixed = stage["mixing"](spark, alone, "").cache()
    assert mixed.columns == docs.columns and mixed.count() == mixing.mix(alone).count()
    packed = stage["packing"](spark, mixed, "").collect()
    assert sum(r["start"] == 0 for r in packed) == mixed.count()


CLASH = ", n_lines string, n_dropped string, kept string, copy string, component_id string, _row string, n_words string"


def test_run_equals_the_stages_one_by_one(spark, tmp_path):
    spark.createDataFrame(corpus(40, 4), DOCS).write.parquet(f"{tmp_path}/sf/documents.parquet")
    want = spark.read.parquet(f"{tmp_path}/sf/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, "")
    got = corpus_pipeline.run(spark, f"{tmp_path}/sf")
    by_piece = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in df.collect() if r["length"] == r["doc_tokens"])
    assert got.columns == want.columns and by_piece(got) == by_piece(want) and by_piece(got)
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_on_odd_rows(spark):
    """Nulls in every column, an empty table, repeated rows, a text of two megabytes, and columns named like those of results."""
    long = " ".join(f"word{i}" for i in range(250_000))
    good = " ".join(f"plain{i}" for i in range(80))
    rows = [(None, good, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, good, "en", None, 1), (3, good, "en", None, 1), (4, good, "en", "s", 1), (5, long, "en", "s", 1)]
    df = spark.createDataFrame([r + tuple(f"c{i}" for i in range(7)) for r in rows], DOCS + CLASH)
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda out: sorted(r["doc_id"] or 0 for r in out.collect())
    out = {name: stage[name](spark, df, "") for name in list(stage)[:-1]}
    assert all(x.columns == df.columns for x in out.values())
    assert ids(out["quality_rules"]) == [0, 3, 3, 4, 5]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out["line_dedup"].collect()) == sorted([(0, good), (1, ""), (2, ""), (3, good), (3, good), (4, ""), (5, long)])
    assert ids(out["ngram_jaccard_join"]) == [0, 1, 2, 3, 3, 5]
    assert set(ids(out["mixing"])) <= {0, 1, 2, 3, 4, 5}
    pieces = stage["packing"](spark, df, "").collect()
    assert sum(r["start"] == 0 for r in pieces) == len(rows) and sum(r["length"] for r in pieces if r["doc_id"] == 5) == max(r["doc_tokens"] for r in pieces)
    for name, f in stage.items():
        assert f(spark, spark.createDataFrame([], DOCS + CLASH), "").count() == 0, name
