"""A language whose rows repeat few ids."""

from pyspark.sql import functions as F

from prosemill.llm import langid


def test_language_of_few_ids_is_learnt(spark):
    few = spark.range(100_000).select((F.col("id") % 3).alias("doc_id"), F.lit("die Katze sitzt auf dem Dach").alias("text"), F.lit("de").alias("lang"))
    many = spark.range(100, 150).select(F.col("id").alias("doc_id"), F.lit("the cat sits on the roof").alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(few.unionByName(many), F.lit(True))
    assert set(model.dictionaries.labels) == {"de", "en"}
