"""Text signals are worked out where the documents are."""

from pyspark.sql import functions as F

from chunkloom.functions import text
from chunkloom.operators import retrieval


def test_few_and_many_terms_give_the_same_without_a_shuffle(spark, monkeypatch):
    docs = [(k, f"word{k % 7} word{k % 5} word{k % 5} Ünder_score x{k}") for k in range(200)] + [(500, None), (501, ""), (502, "дом 東京 ..."), (7, "word0 twice word3 again x"), (7, "word3 twice word0 word0 x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(1, "word1 word3 word3 nowhere"), (2, "Word0"), (3, ""), (4, "nowhere"), (5, None)], "query_id long, query string")
    few = retrieval.text_signals(df, asked, "doc_id", text.words)
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(retrieval, "MOST_BROADCAST", 1)
    assert got == sorted(map(tuple, retrieval.text_signals(df, asked, "doc_id", text.words).collect())) and len(got) > 50
    assert retrieval.text_signals(df.limit(0), asked, "doc_id", text.words).count() == 0


def test_words_are_matched(spark):
    rows = spark.createDataFrame([("A-b_c  9Я東x...",), ("",), (None,), (" .",)], "t string").select(text.words(F.col("t")).alias("w"))
    assert [r.w for r in rows.collect()] == [["a", "b_c", "9", "x"], [], [], []]
    assert "split(" not in rows._jdf.queryExecution().toString()  # splitting at a negated class takes ten times as long
