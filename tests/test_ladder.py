"""The mart's segment of each of the 125 score codes, written out."""

from pyspark.sql import functions as F

from tillroll.functions.classes import rfm_segment_mart, rfm_segment_study

NAMES = {"C": "Champions", "X": "Cannot lose", "A": "At risk", "L": "Loyal customers", "P": "Potential loyalists", "N": "New customers",
         "O": "Promising", "E": "Need attention", "S": "About to sleep", "H": "Hibernating"}
# A line a recency score; in it a word a frequency score 1..5, in that a letter a monetary score 1..5.
MART = """HHHHH HHHHH AAAAA AAAAA AAAXX
HHHHH HHHHH AAAAA AAAAA AAAXX
SSSSS SSSSS EEEEE LLLLL LLLLL
OOOOO PPPPP PPPPP LLLCC LLLCC
NNNNN PPPPP PPPPP LLLCC LLLCC"""
# A line a recency score, a letter a frequency score.
STUDY = """HHAAX
HHAAX
SSELL
OPPLL
NPPCC"""


def test_every_code_of_the_mart(spark):
    want = {(r, f, m): NAMES[letter] for r, line in enumerate(MART.split("\n"), 1) for f, word in enumerate(line.split(), 1)
            for m, letter in enumerate(word, 1)}
    codes = spark.createDataFrame(list(want), "r int, f int, m int")
    got = {(x.r, x.f, x.m): x.s for x in codes.withColumn("s", rfm_segment_mart(F.col("r"), F.col("f"), F.col("m"))).collect()}
    assert got == want and len(want) == 125


def test_every_code_of_the_study(spark):
    want = {f"{r}{f}": NAMES[letter] for r, line in enumerate(STUDY.split("\n"), 1) for f, letter in enumerate(line, 1)}
    codes = spark.createDataFrame([(c,) for c in want], "c string")
    assert {x.c: x.s for x in codes.withColumn("s", rfm_segment_study(F.col("c"))).collect()} == want and len(want) == 25
