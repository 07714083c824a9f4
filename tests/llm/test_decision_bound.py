"""The bound on what operator 4 learns from, with an id that holds a third of labels or documents."""

from pyspark.sql import functions as F

from lakeshift.llm import decision_list


def test_hot_ids_never_exceed_the_sample(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    labels = spark.range(30_000).select(hot.alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    docs = spark.range(30_000).select(hot.alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 20_000).alias("text"))
    chosen = decision_list.labelled(docs, labels, 500, 7)
    assert chosen.count() == 500
    alike = spark.range(30_000).select(F.lit(7).alias("doc_id"), F.lit("one text").alias("text"))
    assert decision_list.labelled(alike, labels.where("doc_id = 7"), 500, 7).count() == 2  # both labels of one text


def test_rows_that_repeat_are_learned_from_once(spark):
    good, bad = "a fine sentence of many words " * 12, "# $ % & | < > * word " * 12
    rows = [(k, f"{bad if k % 2 else good} {k} w{k * 7}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    once = decision_list.fit(docs, labels)
    again = decision_list.fit(docs.union(docs.where("doc_id < 50")).union(docs.where("doc_id = 3")), labels.union(labels))
    assert once == again
