"""Rows that share an id are classed each by its own text or vector; columns of any name go through the pipeline."""

import corpus_pipeline
from tidalrec.llm import lattice, tensor_minhash
from tidalrec.llm.tensor_minhash import NearDedup

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
C = " ".join(f"gamma{i}" for i in range(60))


def test_documents(spark):
    rows = [(1, A), (5, A + " z"), (5, B), (5, C), (7, C + " y"), (7, B + " x"), (9, None), (5, None)]
    got = {(r.doc_id, r.text): (r.component_id, r.kept) for r in tensor_minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), NearDedup(), carry=("text",)).collect()}
    assert got == {(1, A): (1, True), (5, A + " z"): (1, False), (5, B): (5, True), (5, C): (5, True), (7, C + " y"): (5, False),
                   (7, B + " x"): (5, False), (9, None): (9, True), (5, None): (5, True)}


def test_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (5, [1.0, 0.01, 0.0, 0.0]), (5, [0.0, 0.0, 1.0, 0.0]), (6, [0.0, 0.0, 1.0, 0.01]), (8, [0.0, 0.0, 0.0, 1.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (5, 1, 1, False), (5, 1, 5, True), (6, 1, 5, False), (8, 0, 8, True)]


def test_clashing_columns_are_carried(spark, tmp_path):
    names = ["text_digest", "first_digest", "last_digest", "kept_id", "kept_digest", "shared_id", "row_key", "own_id", "own_digest",
             "row", "kept", "component_id", "id", "t", "n", "d1", "least", "a.b"]
    rows = [(i, text, "en", "s", 1, *[f"{n}{i}" for n in names]) for i, text in ((1, A), (2, A + " z"), (3, B), (None, C), (None, B))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{n}` string" for n in names))
    spark.createDataFrame([(3, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names], name
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text[:5]) for r in kept) == [("1", "alpha"), ("3", "beta0"), ("None", "gamma")]
