"""The pipeline's stages decide on rows, not on ids that are null or repeat."""

import corpus_pipeline as C
from brute import SF, table
from pyspark.sql import functions as F

from tillroll.llm import quality_model


def test_a_row_is_kept_by_its_own_score(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    good = {r.text for r in docs.join(quality_model.quality_scores(docs, labels).where("predicted = 1"), "doc_id").collect()}
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, -5).otherwise(F.col("doc_id")))
    labelled = docs.unionByName(odd.where("doc_id is null or doc_id = -5"))  # the labelled rows, as above, and odd ones
    rows = C.keep_quality(spark, labelled, SF).where("doc_id is null or doc_id = -5").collect()
    want = sorted(r.text for r in odd.where("doc_id is null or doc_id = -5").collect() if r.text in good)
    assert sorted(r.text for r in rows) == want and 0 < len(want) < odd.count()


def _text(k, n=90):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_one_row_of_a_group_whatever_the_ids(spark):
    rows = [(None, _text(1)), (None, _text(1)), (None, _text(2)), (7, _text(3)), (7, _text(3)), (7, _text(4)), (9, _text(2) + " more"), (8, _text(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in C.drop_near_duplicates(spark, docs, SF).collect())
    assert got == sorted([("None", _text(1)), ("7", _text(3)), ("7", _text(4)), ("9", _text(2) + " more"), ("8", _text(5))])


def test_stages_carry_columns_of_any_name(spark):
    names = ["__row", "number", "row", "stats", "text_a", "keys", "a.b"]
    docs = table(spark, "documents").select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    kept = C.drop_near_duplicates(spark, docs.limit(50), SF)
    assert kept.dtypes == docs.dtypes and kept.where("`__row` = 0 and number = 1 and `a.b` = 6").count() == kept.count() > 0
    good = C.keep_quality(spark, docs, SF)
    assert good.dtypes == docs.dtypes and good.where("row = 2 and stats = 3").count() == good.count() > 0
