"""The pipeline's near-duplicate stage on repeated rows, null ids and shared ids."""

from corpus_pipeline import duplicates


def test_each_row_goes_or_stays_by_its_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(9, a), (2, a + " end"), (2, b), (5, c), (5, c), (None, d), (None, d), (7, b), (None, a), (2, a + " end"), (6, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(2, a + " end"), (2, b), (5, c), (None, d), (6, None), (None, "")], key=str)


def test_a_column_named_as_the_row_numbers_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "x"), (2, text, "y"), (3, "other words", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    assert sorted(map(tuple, duplicates(spark, docs, "").collect())) == [rows[0], rows[2]]
