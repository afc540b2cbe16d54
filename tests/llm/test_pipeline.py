"""The stages one after the other, each against its operator and against brute force on its own input."""

import corpus_pipeline as P
from __spark_entry__ import queries
from aeromart.llm.common import written
from tests.llm.data import frame, odd_rows
from tests.llm.test_bpe import expected as tokens
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import expected as components

FOLDER = "/root/testdata/sf0.01"


def test_stages_on_their_own_input(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    inputs = [docs]
    for name, stage in P.STAGES:
        inputs.append(written(stage(spark, inputs[-1], FOLDER), name))
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in inputs]
    assert all(x.columns == docs.columns for x in inputs[:-1])
    assert all(a >= b for a, b in zip(ids, ids[1:]))
    # toxicity: toxic documents go, others stay
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = ids[0] - ids[1]
    assert sum(labels.get(d, 1) for d in gone) >= 0.7 * len(gone) and len(gone) >= 0.05 * len(ids[0])
    # language: every document here has letters
    assert ids[1] == ids[2]
    # near duplicates: one of each group
    left = [(r.doc_id, r.text) for r in inputs[2].select("doc_id", "text").collect()]
    assert ids[3] == {d for d, _, c in components(left) if d == c}
    # benchmark
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rare = {w for _, t in items for w in t.lower().split() if len(w) > 9}
    left = [(r.doc_id, r.text) for r in inputs[3].select("doc_id", "text").collect()]
    hit = {r[0] for r in brute([x for x in left if rare & set(x[1].lower().split())][:60], items) if r[5]}
    assert not hit & ids[4]
    # tokens
    text = {r.doc_id: r.text for r in inputs[4].select("doc_id", "text").collect()}
    for r in inputs[5].limit(100).collect():
        assert tuple(r)[1:] == tokens(library, text[r.doc_id])


def test_run_is_registered(spark):
    assert queries()["pipeline"] is P.run
    assert P.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_odd_and_empty_tables(spark, tmp_path):
    for name, rows in (("odd", odd_rows()), ("none", [])):
        folder = str(tmp_path / name)
        docs = frame(spark, rows)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "w1 w2")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        made = P.run(spark, folder)
        assert made.columns[0] == "doc_id" and made.count() <= len(rows)
