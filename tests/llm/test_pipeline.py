"""The pipeline's stages against the operators' rows, and the queries that have SQL."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from dossierlake.llm import near_dup, quality_bayes, toxicity
from dossierlake.llm.queries import CATALOG
from tests.llm.data import TEXTS, documents, labels
from tests.llm.test_toxicity import corpus
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    texts, marks = corpus(120)
    docs = [(i, t.upper().replace(" ", "!! ") if i % 6 == 1 else t) for i, t in enumerate(texts)]
    docs += [(200 + i, t) for i, t in docs[:20]] + [(i + 1000 if i is not None else None, t) for i, t in TEXTS]
    root = str(tmp_path_factory.mktemp("tables"))
    documents(spark, docs).write.parquet(f"{root}/documents.parquet")
    labels(spark, [(i, int(i % 6 != 1), int(m)) for i, m in enumerate(marks)]).write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_apply_their_operators(spark, tables):
    docs, known = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    names = docs.columns

    def texts(frame):
        return Counter((r["doc_id"], r["text"]) for r in frame.collect())

    (_, stage), *rest = corpus_pipeline.STAGES
    after = corpus_pipeline.materialize(stage(spark, docs, tables), "t1")
    net = toxicity.fit(docs, known)
    kept = toxicity.with_scores(docs, net, "text", "own_score").where("own_score < 0.3")
    assert after.columns == names and texts(after) == texts(kept) and 0 < after.count() < docs.count()

    docs, stage = after, rest[0][1]
    after = corpus_pipeline.materialize(stage(spark, docs, tables), "t2")
    rows = quality_bayes.classify(docs, known).where("kept").collect()
    assert after.columns == names and Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts(after).elements())
    assert 0 < after.count() < docs.count()

    docs, stage = after, rest[1][1]
    after = corpus_pipeline.materialize(stage(spark, docs, tables), "t3")
    classes = {(r["doc_id"], r["class_id"]) for r in near_dup.near_duplicates(docs).collect()}
    want = {c for i, c in classes if i is not None}
    assert after.columns == names
    got = Counter(r["doc_id"] for r in after.where("doc_id IS NOT NULL").collect())
    assert set(got) == want and set(got.values()) == {1}
    assert after.where("doc_id IS NULL").count() == docs.where("doc_id IS NULL").count()
    assert after.count() < docs.count()

    packed = rest[2][1](spark, after, tables)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(got) | {
        r["doc_id"] for r in after.where("doc_id IS NULL").select("doc_id").collect()
    }


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, (_, sql) in CATALOG.items() if sql])
def test_query_equals_sql(spark, name):
    query, sql = CATALOG[name]
    assert compare(spark, connect(SF_DIR), query, sql, SF_DIR) is None
