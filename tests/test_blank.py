from pyspark.sql import functions as F

from sieve.functions.text import is_blank, js_trim


def test_unicode_blanks(spark):
    rows = [(" 　﻿",), (" \t\n",), (None,), (" x ",), ("a b",)]
    got = spark.createDataFrame(rows, "q string").select(is_blank(F.col("q")).alias("b"), js_trim(F.col("q")).alias("t")).collect()
    assert [r.b for r in got] == [True, True, True, False, False]
    assert [r.t for r in got][3:] == ["x", "a b"]
