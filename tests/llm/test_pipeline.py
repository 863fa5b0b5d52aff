"""The pipeline's stages and the registered queries."""
import zlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from tidings.llm.vocab import Encoder, path_of
from tidings.session import BASE_CONF, written

SF = "/root/testdata/sf0.001"
NAMES = ["op1_language_id", "op2_token_shards", "op3_source_mix", "op4_token_counts", "op5_multi_index", "op6_weighted_minhash",
         "op7_best_fit", "op8_chunk_prints", "op9_host_paths", "op10_line_frequency", "pipeline"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    assert set(NAMES) <= set(__spark_entry__.queries())
    assert {"op3_source_mix", "op10_line_frequency"} <= set(__spark_entry__.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((docs, stage(spark, docs, SF)))
        docs = written(out[-1][1], "test-stage")
        out[-1] += (docs,)
    return out


def test_a_stage_alone_sets_the_batches_of_its_tasks(spark):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(rows)
        try:
            stage(spark, docs, SF)
            assert spark.conf.get(rows) == BASE_CONF[rows], name
        finally:
            spark.conf.set(rows, BASE_CONF[rows])


def test_stage_columns_and_decisions(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "MinHash near-dedup", "source mix", "best-fit packing"]
    for _, _, after in stages[:4]:
        assert after.columns == COLUMNS
    rows = [after.count() for _, _, after in stages[:4]]
    start = stages[0][0].count()
    assert rows[0] >= 0.97 * start and rows[1] == rows[0] and 0.5 * start < rows[2] < rows[1]
    lined = stages[1][2].selectExpr("sum(abs(n_chars - char_length(text)))").first()[0]
    assert lined == 0
    assert stages[2][2].groupBy("doc_id").count().where("count > 1").count() == 0
    assert {r.doc_id for r in stages[3][2].select("doc_id").distinct().collect()} <= {r.doc_id for r in stages[2][2].select("doc_id").collect()}


def test_last_stage_packs_the_mix(stages):
    docs, _, pieces = stages[4]
    e = Encoder(path_of("byte_bpe_50k.json"), words=False)
    texts = docs.select("doc_id", "text").collect()
    ids = [x + (2).to_bytes(4, "little") for x in e.encode([r.text for r in texts])]
    got = pieces.collect()
    assert sum(r.length for r in got) == sum(len(x) // 4 for x in ids)
    by = {}
    for r, x in zip(texts, ids):
        by.setdefault(r.doc_id, x)
    assert all(zlib.crc32(by[r.doc_id][4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 for r in got)
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024 and np.mean(list(used.values())) > 850


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "the text of a document", None, "a", 1),
            (3, "the text of another document\n" * 3000, "en", None, 1), (4, "the text of another document", "fr", "b", 1)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-odd")
        if name != "best-fit packing":
            assert docs.columns == COLUMNS
    assert docs.count() > 0
