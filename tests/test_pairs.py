"""Whole-line pair matching (traps T2, T11) and re-keying."""

import pytest

from keytally.operators.pairs import split_pairs

PASS = ["alice,red", ",white"]
FAIL = ["A,red", "a,red,red", "a,blue", "a1,red", "a,red ", "a,red\n"]


def test_pairs_filter_and_split(spark):
    rows = [(i, v) for i, v in enumerate(PASS + FAIL + [None])]
    df = spark.createDataFrame(rows, "offset long, value string")
    got = sorted((r["key"], r["value"]) for r in split_pairs(df).collect())
    assert got == [("", "white"), ("alice", "red")]


@pytest.mark.parametrize("line", FAIL)
def test_each_bad_line_fails(spark, line):
    df = spark.createDataFrame([(0, line)], "offset long, value string")
    assert split_pairs(df).count() == 0


def test_allowed_values_parameter(spark):
    df = spark.createDataFrame([(0, "ab,click"), (1, "ab,red")], "offset long, value string")
    assert [r["value"] for r in split_pairs(df, allowed=("click", "view")).collect()] == ["click"]
