"""Very long words in every operator on texts, whole secret values, and mixes of repeated
rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from keytally.llm import (common, ctw_scoring, fingerprints, quality_cnn, secrets, sentencepiece_codec, simhash_dedup,
                          source_mix, suffix_dedup, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SEPARATORS = list(":=./-_@#&?%+~,;!\"'`<>()[]{}|\\$^*")


@pytest.fixture(scope="module")
def model(spark):
    return secrets.forest(spark)


def long_words():
    key = "Abc123def456ghi789"
    words = [s * 100_000 + key for s in SEPARATORS] + [("a" + s) * 50_000 + key for s in ":=./-@"]
    words += ["x" * 100_000, "a1" * 50_000, "aB" * 50_000, "password:" * 12_000 + key, "://a:" * 20_000, "漢" * 30_000]
    return [(k, f"see {w} end", "en", "a", 1) for k, w in enumerate(words)]


def test_long_words_of_every_separator_in_secrets(spark, model):
    rows = long_words()
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    out = {r["doc_id"]: r["text"] for r in secrets.redacted(docs, model=model).collect()}
    assert set(out) == {r[0] for r in rows} and all(t.startswith("see ") and t.endswith(" end") for t in out.values())


def test_long_words_in_the_other_operators(spark):
    """One word of each kind, a colon chain, a text without white space."""
    rows = [r for r in long_words() if r[0] % 9 == 0] + [(900, "a:" * 1200 + "Abc123def456ghi789", "en", "b", 1),
                                                         (901, "nospace" * 3000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], r[0] % 2, (r[0] // 2) % 2) for r in rows], "doc_id long, quality int, toxic int")
    n = len(rows)
    assert quality_cnn.quality(docs, labels).count() == n and toxicity.toxicity(docs, labels).count() == n
    assert simhash_dedup.keep_one_per_group(docs).count() >= 1
    assert ctw_scoring.lm_scores(docs).count() == n and suffix_dedup.repeats_removed(docs).count() == n
    assert source_mix.mix_sizes(docs).count() == n and fingerprints.op7_fingerprints is not None
    back = sentencepiece_codec.round_trip(docs).where(F.col("decoded").eqNullSafe(F.col("text")))
    assert back.count() == n


def test_whole_values_behind_names_and_in_addresses(spark, model):
    held = [("password: correcthorsebatterystaple now", "correcthorsebatterystaple"),
            ("set password=hunter2X9!kk here", "hunter2X9!kk"), ("my secret = Tr0ub4dor&3x ok", "Tr0ub4dor&3x"),
            ("open https://bob:s3cretPw99x@db.example.com/x?y=1 please", "s3cretPw99x"),
            ('api_key="a8$kd92!mzPq41" # set', "a8$kd92!mzPq41")]
    clean = ["the password is required immediately by the service", "token: authentication", "password: $USER_PASSWORD",
             "secret: example.user.password", "open https://www.example.com:8080/index/page today", "auth: none given here"]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(held)] + [(100 + k, t) for k, t in enumerate(clean)],
                               "doc_id int, text string")
    found = {(r["doc_id"], r["value"]) for r in secrets.scan(df, model=model).where("is_secret").collect()}
    assert found == {(k, v) for k, (_, v) in enumerate(held)}
    out = {r["doc_id"]: r["text"] for r in secrets.redacted(df, model=model).collect()}
    assert all(out[k] == t.replace(v, secrets.MASK) for k, (t, v) in enumerate(held))
    assert all(out[100 + k] == t for k, t in enumerate(clean))


# --- mixes -------------------------------------------------------------------------------

def mix_rows():
    """20 sources of 50 documents with sizes from one to thousands of words, and one text
    that holds a third of all rows."""
    rows = [(s * 1000 + d, " ".join(["w"] * (1 + (d * d * 37 + s * 11) % 2500)), "en", f"s{s:02d}", d)
            for s in range(20) for d in range(50)]
    return rows + [(77, "same old words again " * 3, "en", "s03", 1)] * 500 + [(77, "other words", "en", "s03", 1)] * 7


def test_every_source_comes_near_its_target(spark):
    docs = spark.createDataFrame(mix_rows(), DOCS).repartition(4)
    out = source_mix.mix_sizes(docs).cache()
    assert out.count() == 1507
    per = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    for r in per:
        assert abs(r["taken"] - r["target"]) <= 0.02 * r["target"] + 1, r
    assert out.where("taken > 3 * size").count() == 0
    assert {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum("size").alias("n")).collect()} == \
        {r["source"]: r["s"] for r in out.groupBy("source").agg(F.max("source_size").alias("s")).collect()}


def test_the_mix_is_the_same_for_every_split_of_the_input(spark):
    docs = spark.createDataFrame(mix_rows(), DOCS)
    # rows of one id, source and size, told apart by their text alone
    twins = spark.createDataFrame([(5, "alpha beta", "en", "s01", k) for k in range(9)]
                                  + [(5, "gamma delta", "en", "s01", k) for k in range(9)], DOCS)
    all_rows = docs.unionByName(twins)
    a = Counter(tuple(r) for r in source_mix.mixed(all_rows.repartition(3)).collect())
    b = Counter(tuple(r) for r in source_mix.mixed(all_rows.repartition(7).orderBy(F.desc("text"))).collect())
    assert a == b
    sizes = source_mix.mix_sizes(all_rows).agg(F.sum("taken")).first()[0]
    assert abs(sum(len(r[1].split()) * n for r, n in a.items()) - sizes) <= 0.02 * sizes


def test_landing_takes_the_choice_that_misses_least():
    size, p = [3.0, 5.0, 8.0, 13.0, 100.0], [0.5, 0.5, 0.25, 0.5, 0.2]
    want = sum(s * q for s, q in zip(size, p))
    taken = source_mix.land(size, list(p))
    best = min(abs(sum(s for k, s in enumerate(size) if bits >> k & 1) - want) for bits in range(32))
    assert abs(sum(s * q for s, q in zip(size, taken)) - want) == pytest.approx(best)


def test_sample_counts_an_id_once_and_is_bounded_in_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "b" * 30, "", "", 1)] * 200 + [(1, "a" * 30, "", "", 1)] + [(k, "t" * k, "", "", 1) for k in range(2, 60)], DOCS)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 60)], "doc_id long, quality int, toxic int")
    whole = common.labelled_sample(docs, labels, "quality", 1000, 999, 100)
    assert len(whole) == 59 and ("a" * 30, 1) in whole and sum(t.startswith("b") for t, _ in whole) == 0
    monkeypatch.setattr(common, "SAMPLE_BYTES", 300)
    some = common.labelled_sample(docs, labels, "quality", 1000, 999, 100)
    assert 0 < sum(len(t) for t, _ in some) <= 300
