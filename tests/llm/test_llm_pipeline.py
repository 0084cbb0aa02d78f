"""The pipeline's stages, each against what its operator decides."""

import collections

import pytest

import corpus_pipeline
from cityair.llm import near_dup, quality, suffix_dedup
from cityair.llm.common import landed, table
from conftest import SF0001
from test_llm_text import brute_classes, check_pack, removed


def test_stages_take_effect(spark):
    docs = table(spark, SF0001, "documents")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = landed(stage(spark, docs, SF0001), f"test-{name}")
        out.append(docs)
    good, unlike, cut, mixed, packed = out
    first = table(spark, SF0001, "documents")
    assert all(x.columns == first.columns for x in out[:-1])
    judged = quality.judge(first, table(spark, SF0001, "labels")).where("keep")
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in judged.collect()) == sorted(r[0] for r in rows)
    label = dict(zip([r[0] for r in rows], brute_classes(rows)))
    left = [(r.doc_id, r.text) for r in unlike.collect()]
    assert sorted(label[r[0]] for r in left) == sorted(set(label.values()))
    kept = {r.doc_id: len(r.text.encode()) for r in cut.collect()}
    want = removed([r[1].encode() for r in left], suffix_dedup.WINDOW)
    for (doc, _), (n, gone, *_) in zip(left, want):
        assert n - gone - 6 <= kept[doc] <= n - gone
    assert (near_dup.SIMILARITY, suffix_dedup.WINDOW) == (0.8, 200)
    words = collections.Counter()
    size = collections.Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    for r in cut.collect():
        size[r.doc_id] += len(r.text.split())
    assert all(words[d] <= 3 * size[d] for d in words)
    assert abs(sum(words.values()) - sum(size.values())) < 50
    n, least = check_pack([(r.doc_id, r.text) for r in mixed.collect()], packed.collect(), 2048)
    assert n <= 1.02 * least + 1


def test_run_chains_the_stages(spark, monkeypatch):
    seen = []

    def stage(keep):
        def run(session, docs, sf_dir):
            seen.append((docs.count(), sf_dir))
            return docs.where(keep)
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage("doc_id % 2 = 0")),
                                                    ("b", stage("doc_id % 3 = 0"))])
    rows = corpus_pipeline.run(spark, SF0001).collect()
    total = table(spark, SF0001, "documents").count()
    assert seen == [(total, SF0001), (-(-total // 2), SF0001)]
    assert rows and all(r.doc_id % 6 == 0 for r in rows)


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_duplicates", "suffix_dedup", "source_mixing",
        "best_fit_packing"]


@pytest.mark.parametrize("texts", [[], [None, "", " \n", "five words of one text", None]])
def test_run_on_empty_tables_and_null_texts(spark, tmp_path, texts):
    schema = table(spark, SF0001, "documents").schema
    rows = [(i, t, None, None, None) if t is None else (i, t, "en", "web", len(t))
            for i, t in enumerate(texts)]
    order = ["doc_id", "text", "lang", "source", "n_chars"]
    assert schema.names == order
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF0001, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Texts without words are taken 0 times by the mixture.
    assert {r.doc_id for r in got} <= {i for i, t in enumerate(texts) if t and t.strip()}
    assert all(r.offset + r.length <= 2048 for r in got)
