"""Arrow batches of the pipeline's stages: bounded by bytes, so that Python workers stay small whatever the texts."""

import corpus_pipeline
from lakeshift.llm import common, sentence_spans
from lakeshift.llm.common import BATCH_BYTES_KEY, SMALL_BYTES


def long_texts(spark, n=48):
    """``n`` documents of some 200,000 bytes each, in one partition."""
    return spark.range(0, n, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', cast(id as string), ' and more. '), 15000) as text")


def test_stages_bound_what_a_batch_holds(spark):
    before = spark.conf.get(BATCH_BYTES_KEY)
    try:
        for name, stage in corpus_pipeline.STAGES[1:3]:  # the others need labels and a vocabulary
            spark.conf.set(BATCH_BYTES_KEY, before)
            stage(spark, long_texts(spark, 2), "")

            def sizes(batches):
                for batch in batches:
                    yield batch.select(["doc_id"]).append_column("n", common.pa.array([batch.nbytes] * len(batch)))

            most = long_texts(spark).mapInArrow(sizes, "doc_id long, n long").agg({"n": "max"}).first()[0]
            assert most <= SMALL_BYTES + 300_000, name  # it may pass the bound by one text
    finally:
        spark.conf.set(BATCH_BYTES_KEY, before)


def test_the_pipeline_leaves_the_session_as_it_was(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, n_chars int").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    before = spark.conf.get(BATCH_BYTES_KEY)
    corpus_pipeline.run(spark, tmp_dir)
    assert spark.conf.get(BATCH_BYTES_KEY) == before


def test_spans_of_long_texts_are_cut_into_small_slices():
    batch = common.pa.record_batch({"text": ["x" * 400_000] * 12})
    assert [len(s) for s in common.slices([batch], "text", SMALL_BYTES)] == [2] * 6
    assert sum(len(s) for s in common.slices([batch], "text")) == 12


def test_spans_write_under_the_bound(spark, monkeypatch):
    seen, write = [], common.Stage.write

    def noted(self, df, name):
        seen.append((name, self.batch_bytes))
        return write(self, df, name)

    monkeypatch.setattr(common.Stage, "write", noted)
    sentence_spans.remove_repeats(long_texts(spark, 2))
    assert seen and all(most == SMALL_BYTES for _, most in seen)
