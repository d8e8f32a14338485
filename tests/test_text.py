"""Word splitting (trap T1) and word count."""

import random
import re

import pytest
from pyspark.sql import functions as F

from keytally.functions.text import tokens
from keytally.operators import wordcount
from keytally.sources.topics import text_lines


def jdk_split(line: str) -> list[str]:
    """Reference semantics of ``line.toLowerCase().split("\\\\W+")`` (ASCII \\W)."""
    s = line.lower()
    if s == "":
        return [""]
    parts = re.split(r"[^A-Za-z0-9_]+", s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


# Fixed samples with results confirmed against the JDK's split.
SAMPLES = [
    ("", [""]),
    (" hello world ", ["", "hello", "world"]),
    ("!!!", []),
    (" ", []),
    ("x__1-2", ["x__1", "2"]),
    ("Xin chào", ["xin", "ch", "o"]),
    ("a\n", ["a"]),
]


@pytest.mark.parametrize("line,expected", SAMPLES)
def test_tokens_match_jdk_split(spark, line, expected):
    got = spark.createDataFrame([(line,)], "value string").select(tokens("value").alias("t")).first()["t"]
    assert got == expected
    assert jdk_split(line) == expected


def test_tokens_null_line(spark):
    assert spark.createDataFrame([(None,)], "value string").select(tokens("value").alias("t")).first()["t"] is None


def test_tokens_random_lines_match_reference_rule(spark):
    import random
    rnd = random.Random(7)
    alphabet = "ab Z_9 -!\n\tàé.,"
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i long, value string")
    got = {r["i"]: r["t"] for r in df.select("i", tokens("value").alias("t")).collect()}
    for i, l in enumerate(lines):
        assert got[i] == jdk_split(l), repr(l)


def test_word_count_counts_empty_word(spark):
    df = spark.createDataFrame([(1, "Hello hello"), (2, ""), (3, " a"), (4, None)], "offset long, value string")
    got = {r["word"]: r["count"] for r in wordcount.word_count(df).collect()}
    assert got == {"hello": 2, "": 2, "a": 1}


def test_running_word_count_brute_force(spark):
    lines = [(i, t) for i, t in enumerate(["the cat the", "The dog", "", "cat THE the", "x"] * 7)]
    df = spark.createDataFrame(lines, "offset long, value string")
    got = sorted(tuple(r) for r in wordcount.running_word_count(df, bounds=(0, len(lines) - 1), buckets=5).collect())
    seen, want = {}, []
    for off, t in lines:
        for pos, w in enumerate(jdk_split(t)):
            seen[w] = seen.get(w, 0) + 1
            want.append((off, pos, w, seen[w]))
    assert got == sorted(want)


def read_log(lines):
    """The word log of (offset, text) lines: by offset (null first), then position."""
    toks = [(off, pos, w) for off, t in lines if t is not None for pos, w in enumerate(jdk_split(t))]
    seen, want = {}, []
    for off, pos, w in sorted(toks, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen[w] = seen.get(w, 0) + 1
        want.append((off, pos, w, seen[w]))
    return want


def by_place(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("group_chars", [1, 40, 1 << 20])
def test_running_word_count_odd_lines(spark, group_chars):
    """Lines without a place, lines that share one, and buckets too large for one group."""
    rnd = random.Random(9)
    lines = [(rnd.choice([None, *range(30), -5, 10**15]),
              rnd.choice([None, "", "!!!", " ".join(rnd.choices(["a", "b", "c", "Ünï", "x-y"], k=rnd.randint(1, 9)))]))
             for _ in range(200)]
    df = spark.createDataFrame(lines, "offset long, value string")
    got = wordcount.running_word_count(df, buckets=4, group_chars=group_chars)
    assert by_place(got.collect()) == by_place(read_log(lines))


def test_running_word_count_without_lines(spark):
    none = spark.createDataFrame([], "offset long, value string")
    assert wordcount.running_word_count(none).collect() == []
    nulls = spark.createDataFrame([(1, None), (None, "a a")], "offset long, value string")
    assert by_place(wordcount.running_word_count(nulls).collect()) == [(None, 0, "a", 1), (None, 1, "a", 2)]


def test_running_word_count_shuffles_lines_not_words(spark):
    lines = [(i, "the cat the") for i in range(50)]
    df = spark.createDataFrame(lines, "offset long, value string")
    plan = wordcount.running_word_count(df, buckets=5)._jdf.queryExecution().optimizedPlan().toString()
    # one window, over the totals; before, a second one sorted every word of every line
    assert plan.count("Window [") == 1 and "Generate" not in plan


def test_word_count_on_documents_plan_is_partial_then_final(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = wordcount.word_count(text_lines(docs))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Generate" in plan
    # only the text column is read
    scan = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<text:string>" in scan or "struct<text:string>" in scan
    assert df.count() > 0


def test_unicode_option(spark):
    df = spark.createDataFrame([(0, "Xin chào, thế giới!")], "offset long, value string")
    ascii_words = sorted(r["word"] for r in wordcount.line_tokens(df).collect())
    uni_words = sorted(r["word"] for r in wordcount.line_tokens(df, unicode=True).collect())
    assert ascii_words == sorted(["xin", "ch", "o", "th", "gi", "i"])
    assert uni_words == sorted(["xin", "chào", "thế", "giới"])
