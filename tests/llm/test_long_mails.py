"""Very long lines and runs of blank lines: no stack overflow, linear time."""

import time

from pyspark.sql import functions as F

from rectext.llm import quotations


def test_long_runs_of_marks_and_blank_lines(spark):
    n = 100_000
    rows = [("t", 0, "hello there my friend"), ("t", 1, "> hello there my friend\n" + ">" * n + " deep words"), ("t", 2, "\n" * n + "words" + " \n" * n),
            ("t", 3, " " * n + "x" + " " * n), ("t", 4, "> " * n), ("t", 5, "a" + "\n" * n + "b")]
    began = time.time()
    got = {r["turn"]: r for r in quotations.link_quotations(spark.createDataFrame(rows, "conv_id string, turn long, text string")).collect()}
    assert got[1]["parent_order"] == 0 and got[1]["max_level"] == n and got[2]["own_text"] == "words "
    assert got[3]["own_text"] == " " * n + "x" + " " * n and got[4]["own_text"] == "" and got[5]["own_text"] == rows[5][2]
    assert time.time() - began < 60


def test_blank_ends(spark):
    cases = {"": "", "\n \n": "", "a": "a", " a ": " a ", "\n\n  a b \n\n": "  a b ", "a\n\nb\n": "a\n\nb", " \n\t\n x": " x", "x\n \t": "x", "  ": "  ", "\n  ": "  "}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: r["x"] for r in df.select("t", quotations._without_blank_ends(F.col("t")).alias("x")).collect()}
    assert got == cases
