import os

import pytest
from pyspark.sql import functions as F

from wearline.llm import language
from wearline.llm.queries import PLAIN, ready

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are absent")
def test_held_out_accuracy(spark):
    out = PLAIN["op9_language_id"][0](ready(spark), SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = out.join(truth, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row.right > 0.97 and 0 <= row.low and row.high <= 1


def test_rejects_and_edges(spark):
    english = "the quick brown fox jumps over the lazy dog while other foxes sleep in their den by the river "
    german = "der schnelle braune Fuchs springt über den faulen Hund und schläft dann in seinem Bau am Fluss "
    rows = [(i, english[i % 40:] + english, "en") for i in range(40)] + [(100 + i, german[i % 40:] + german, "de") for i in range(40)]
    train = spark.createDataFrame([*rows, (300, None, "en"), (301, "x", None)], "doc_id long, text string, lang string")
    model = language.fit(train)
    asked = spark.createDataFrame(
        [(1, english, "p"), (2, german.upper(), "p"), (3, None, "p"), (4, "", "p"), (5, "12 34 !", "p"),
         (6, "Съешь же ещё этих мягких французских булок да выпей чаю " * 8, "p"), (None, english * 3000, "p"),
         (1, english, "p")], "doc_id long, text string, score string")
    out = asked.withColumn("p", language.predict_column(spark, model, F.col("text"))).collect()
    assert [(r.p.lang, r.p.rejected) for r in out] == [
        ("en", False), ("de", False), ("und", True), ("und", True), ("und", True), (out[5].p.lang, True), ("en", False), ("en", False)]
    nothing = language.fit(train.limit(0))
    assert asked.withColumn("p", language.predict_column(spark, nothing, F.col("text"))).where("p.lang != 'und'").count() == 0
