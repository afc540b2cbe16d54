from pyspark.sql import functions as F

from aeromart.functions import text as X


def value(spark, column, *texts):
    names = [f"c{i}" for i in range(len(texts))]
    df = spark.createDataFrame([texts], ", ".join(f"{n} string" for n in names))
    return df.select(column).first()[0]


def test_split_trim(spark):
    assert value(spark, X.split_trim(F.col("c0")), " pm1 , voc\t,,pm25\n") == ["pm1", "voc", "", "pm25"]
    assert value(spark, X.split_trim(F.col("c0"), "."), "a. b") == ["a", "b"]
    assert X.name_list(" pm1 , voc") == X.name_list([" pm1", "voc "]) == ["pm1", "voc"]


def test_html_escape(spark):
    assert value(spark, X.html_escape(F.col("c0")), '<a & "b">&lt;') == (
        "&lt;a &amp; &quot;b&quot;&gt;&amp;lt;"
    )


def test_row_key_keeps_neighbours_and_nulls_apart(spark):
    key = X.row_key(F.col("c0"), F.col("c1"))
    keys = {
        value(spark, key, *pair)
        for pair in [
            ("1", "2pm"), ("12", "pm"), ("", "x"), (None, "x"), ("x", None), ("x", ""), ("a|b", "c"), ("a", "b|c"),
            ("\u0000", "x"), ("-", "x"), ("1:1", "1:1"), ("1", "1:11:1"),
        ]
    }
    assert len(keys) == 12
    assert all(len(k) == 40 for k in keys)
