"""Texts in no known language, or in no language, are told from the labelled languages' own."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from ridgeline.llm import langid
from ridgeline.llm.common import table

SF = "/root/testdata/sf0.01"


def noise():
    rng = random.Random(3)
    letters = "".join(chr(c) for c in range(97, 123)) + "     "
    made = ["".join(rng.choice(letters) for _ in range(n)) for n in (60, 200, 1000, 5000) for _ in range(5)]
    return made + [base64.b64encode(rng.randbytes(n)).decode() for n in (100, 400, 2000)]


FOREIGN = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita",
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
           "Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由在尊严和权利上一律平等"]


@pytest.mark.parametrize("label", [None, "en"])
def test_noise_and_foreign_texts_go(spark, label):
    """Also if they come with a label; the documents stay."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    rest = spark.createDataFrame([(-i, x, label, "src0") for i, x in enumerate(noise() + FOREIGN, 1)], docs.schema)
    left = langid.in_known_language(docs.unionByName(rest))
    assert left.filter("doc_id < 0").count() == 0
    assert left.count() >= 0.998 * docs.count()


def test_language_left_out(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "source", F.col("lang").alias("spoken"))
    docs = docs.withColumn("lang", F.when(F.col("spoken") != "fr", F.col("spoken")))
    left = {r.spoken: r["count"] for r in langid.in_known_language(docs).groupBy("spoken").count().collect()}
    all_of = {r.spoken: r["count"] for r in docs.groupBy("spoken").count().collect()}
    assert left.get("fr", 0) <= 0.03 * all_of["fr"]
    assert all(left[x] >= 0.99 * all_of[x] for x in all_of if x != "fr")


def test_noise_in_a_language_of_few_letters(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    few = [(-1, "kurz", "xx", "a"), (-2, "12 34", "yy", "a")] + [(-3 - i, x, None, "a") for i, x in enumerate(noise())]
    left = {r.doc_id for r in langid.in_known_language(docs.unionByName(spark.createDataFrame(few, docs.schema))).collect() if r.doc_id < 0}
    assert left == {-1}
