import numpy as np
import pytest
from tests.llm.cases import no_docs, odd_docs

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tapeline.llm import secret_scan, simhash  # noqa: E402
from tapeline.session import staged  # noqa: E402


def test_stages_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"test-{name}")
        kept[name] = docs.toPandas()
        assert name == "packing" or docs.columns == columns
    spoken, single, masked, mixed, packed = kept.values()
    fp = np.array([simhash.fingerprint(t.encode()) for t in spoken.text], np.uint64)
    alone = np.array([simhash.fingerprint(t.encode()) for t in single.text], np.uint64)
    assert (np.bitwise_count(alone[:, None] ^ alone[None, :]) <= 3).sum() == len(alone)
    assert all((np.bitwise_count(alone ^ x) <= 3).any() for x in fp)  # these groups are no chains
    assert len(masked) == len(single) and not any(s[0] != "entropy" for t in masked.text for s in secret_scan.find_secrets(t))
    assert set(mixed.doc_id) <= set(masked.doc_id) and mixed.groupby("doc_id").size().max() <= 3
    assert packed.length.sum() == packed[packed.start == 0].doc_tokens.sum() and (packed[packed.start == 0].shape[0]) == len(mixed)


def test_every_stage_bears_an_empty_table_and_rows_without_texts(spark):
    blank = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", None, 0), (2, " 12 ", None, "s", 4)], no_docs(spark).schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs(spark), "").count() == 0
        rows = stage(spark, blank, "")
        want = {"language_id": 0, "simhash_near_dedup": 2, "secret_scan": 4, "source_mixing": 1, "packing": 4}[name]
        assert rows.count() == want, (name, rows.collect())


def test_every_stage_leaves_out_other_columns(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs(spark), "").columns == no_docs(spark).columns


def test_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, ""), f"test-{name}")
    assert docs.count() > 0
