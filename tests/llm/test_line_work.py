"""Line dedup splits and shuffles no more than it has to: what is done twice, and what is replaced by itself."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quillon.llm import line_quality, line_runs


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_shuffled_once_unless_rows_repeat(spark):
    rows = [(i, f"one  line {i}\n\tTwo\r\n\x0b\nthree ") for i in range(20)]
    schema = "doc_id bigint, text string"
    single = line_runs.line_positions(spark.createDataFrame(rows, schema), "doc_id", "text")
    twice = line_runs.line_positions(spark.createDataFrame(rows * 2, schema), "doc_id", "text")
    assert "Aggregate" not in plan(single)[0] and "Aggregate" in plan(twice)[0]
    found = [sorted(map(tuple, x.select("id", "p", "line", "w", "c").collect())) for x in (single, twice)]
    assert found[0] == found[1] and [(r[1], r[3], r[4]) for r in found[0][:3]] == [(0, 3, 3), (1, 1, 4), (2, 1, 5)]


def test_single_spaces_are_left_alone(spark):
    texts = ["a b c", " a  b\tc ", "\t", " \t \r\n \x0b", "x\r", "\x0cx \t y", "ä ö ü  É", "", "a\t\tb", " ", "q \n w\n\n e  \n"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", line_quality.normal_lines(F.col("t")).alias("l"))
    white = re.compile("[\t\x0b\x0c\r ]+")
    assert {r.i: r.l for r in found.collect()} == {
        i: [x for x in (y.strip(" ") for y in white.sub(" ", t).lower().split("\n")) if x] for i, t in enumerate(texts)}
    assert "contains(" in plan(found)[0].lower()  # the regular expression is for texts with longer runs


def test_lines_are_counted_without_a_split(spark):
    from quillon.session import Scratch

    texts = [None, "", "\n", "a\n", "a\nb", "\n\nä\n"]
    scratch = Scratch(spark)
    done = line_runs.remove_repeated_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), scratch)
    assert {r.doc_id: r["__n_lines"] for r in done.collect()} == {i: 0 if t is None else t.count("\n") + 1 for i, t in enumerate(texts)}
    scratch.clear()
