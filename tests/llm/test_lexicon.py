"""Subsets of the lexicon of I-Match."""

from pyspark.sql import functions as F

from tablemend.llm import fingerprints


def test_every_word_is_a_term_and_short_texts_use_half_of_them_in_each_group(spark):
    rows = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(8)) + " word1")], "doc_id long, text string")
    lexicons = fingerprints.Lexicons(groups=40)
    rows = rows.withColumn("terms", fingerprints.terms("text"))
    got = rows.select(F.size("terms").alias("n"), fingerprints.entries("terms", 3, lexicons).alias("e")).first()
    assert got.n == 8 and 100 < len(got.e) < 220 and {e.version for e in got.e} == {3}
    assert len({e.term for e in got.e}) == 8


def test_long_texts_use_sparse_subsets(spark):
    sizes = [0, 8, 9, 16, 17, 1000, 10**9]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long")
    found = {r.n: r.k for r in rows.select("n", fingerprints.first_level("n", fingerprints.Lexicons()).alias("k")).collect()}
    assert [found[n] for n in sizes] == [1, 1, 1, 1, 2, 7, 14]
