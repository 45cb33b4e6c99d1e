import brute

from flightlake.llm import jaccard
from flightlake.llm.common import keyed


def colliding(spark):
    """Two texts that Spark's 32-bit hash does not tell apart."""
    n = spark.range(400_000).selectExpr("concat('text ', id, ' of many') AS t", "hash(concat('text ', id, ' of many')) AS h")
    return list(n.groupBy("h").agg({"t": "collect_set"}).toDF("h", "t").filter("size(t) = 2").orderBy("h").first()["t"])


def test_texts_of_one_id_are_told_apart(spark):
    a, b = colliding(spark)
    docs = brute.frame(spark, [(None, a), (None, b), (7, a), (7, b)])
    assert keyed(docs).select("doc_id", "_h").distinct().count() == 4
    assert sorted(r["text"] for r in jaccard.one_of_each(brute.frame(spark, [(None, a), (None, b)]), size=5, percent=80).collect()) == sorted([a, b])
