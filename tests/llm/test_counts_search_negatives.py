"""Token counts against the library, lexical search and hard negatives against brute
force, each over odd tables, hot groups and small blocks."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from keytally.llm import hard_negatives, lexical_search, token_counts

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_bytes string, score long, n long"


def odd_docs(spark):
    same = "Same words again and again, SAME words. " * 3
    return spark.createDataFrame(
        [(1, same, "en", "x", 1, 2), (2, same, "en", None, None, 2), (2, same, "en", None, None, 2), (3, None, None, None, None, 1),
         (None, same, "en", "y", 5, 4), (4, "", "en", "", 0, 0), (5, " \t\n.,;", "en", "", 0, 0),
         (6, "lorem ipsum dolor " * 20000, "en", "", 9, 9), (7, "Größe ÄÖ naïve 漢字 \U0001f600 ﬁ again", "de", "", 1, 1),
         (8, "x" * 200000, "en", "", 1, 1)], DOCS)


# --- token counts ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter.from_file()


def test_counts_are_the_librarys(spark, library, counter):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in token_counts.op11_token_counts(spark, SF).collect():
        text = texts[r["doc_id"]]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)


def test_every_character_counts_as_in_the_library(library, counter):
    """Each code point among letters, digits, spaces and signs: the word pattern and the
    library agree on what a letter, a digit and a space is."""
    for low in range(0, 0x110000, 8192):
        texts = [f"a{c}b {c} 1{c}{c}!\n{c}" for c in map(chr, range(low, low + 8192)) if not 0xD800 <= ord(c) < 0xE000]
        if texts:
            want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
            assert [counter.count(t) for t in texts] == want, hex(low)
            counter.clear()


def test_specials_and_random_texts(library, counter):
    rnd = random.Random(3)
    pieces = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "'s", "’s", "the", "THE", " ", "\x85", "é", "漢",
              "\U0001f600", "123", "a" * 300, "ab" * 200, "!?!", "\x00", "​"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    for t in texts + ["", "<|endoftext|>", "<|endoftext|><|endoftext|>"]:
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


def test_what_is_remembered_stays_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    own = token_counts.TokenCounter.from_file()
    for k in range(500):
        assert own.count(f"word{k} tail{k}") == len(library.encode(f"word{k} tail{k}").ids)
    assert len(own) <= 50


def test_token_counts_odd(spark, library):
    docs = odd_docs(spark)
    got = token_counts.token_counts(docs)
    assert got.columns == ["doc_id", "text", "lang", "n_bytes", "score", "n", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == 10
    for r in rows:
        t = r["text"] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 512)
    assert token_counts.token_counts(docs.limit(0)).count() == 0


# --- lexical search ----------------------------------------------------------------------

def words_of(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w)
            for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_search(docs, items, k=10):
    """docs (id, text), items (id, text) -> rows (item, rank, doc, score)."""
    counted = [(d, Counter(words_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words_of(t))
    out = []
    for i, ws in terms.items():
        scored = []
        for d, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in ws if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        scored.sort()
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_terms():
    text = "Ab-c9 _x{ÄÖ}~ﬁ\x00Z\x7fÉ k m"
    assert [w.decode() for w in lexical_search.terms_of(text)] == words_of(text)
    assert lexical_search.terms_of(None) == lexical_search.terms_of("") == []


@pytest.mark.parametrize("size", [(16384, 1000000), (40, 1000000), (16384, 300)])
def test_search_is_that_of_all_documents(spark, size):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = found(lexical_search.search(docs, items, shard_docs=size[0], shard_postings=size[1]))
    assert got == brute_search([(r["doc_id"], r["text"]) for r in docs.collect()],
                               [(r["item_id"], r["text"]) for r in items.collect()])


def test_search_ties_and_skew(spark):
    """A third of the documents are one text; most hold one word; scores tie."""
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(40)]
    docs = [(k, "same old text of w1 w2 w3") for k in range(300)]
    docs += [(1000 + k, " ".join(["of", *rnd.choices(words, k=rnd.randint(1, 12))])) for k in range(600)]
    items = [(k, " ".join(rnd.choices([*words, "of", "text", "never"], k=rnd.randint(1, 9)))) for k in range(40)]
    items += [(40, "same text"), (41, "of"), (42, "never seen"), (43, None), (43, "w1"), (None, "w2 w3")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    it = spark.createDataFrame(items, "item_id long, text string")
    want = brute_search(docs, items)
    assert found(lexical_search.search(df, it, shard_docs=200)) == want
    assert found(lexical_search.search(df, it, at_once=30)) == want  # several groups of items


def test_pair_bounds_read_less_than_single_maxima():
    """Terms that never meet: their pair's bound is one maximum, not the sum, so fewer
    list entries are read for the same answer."""
    rnd = random.Random(1)
    rows = [(0, b"apple"), (0, b"berry"), (0, b"cat"), (0, b"dog"), (0, b"the")]
    items = lexical_search.Items(rows)
    docs = []
    for d in range(20000):
        here = Counter()
        r = rnd.random()
        if r < 0.002:
            here = Counter({b"apple": 3, b"cat": 2, b"dog": 1})
        elif r < 0.3:
            here = Counter({b"berry": 1 + d % 2}) if d % 2 else Counter({b"apple": 1})
        elif r < 0.5:
            here = Counter({b"cat": 1}) if d % 2 else Counter({b"dog": 1})
        here[b"the"] += 1
        docs.append((d, here))
    items.weigh({items.number[w]: sum(w in c for _, c in docs) for w in (b"apple", b"berry", b"cat", b"dog", b"the")}, len(docs))
    terms = [np.array([items.number[w] for w in c], np.int32).tobytes() for _, c in docs]
    tfs = [np.array(list(c.values()), np.int32).tobytes() for _, c in docs]
    lengths = [sum(c.values()) for _, c in docs]
    shard = lexical_search.Shard.build(items, len(docs), sum(lengths), [d for d, _ in docs], [False] * len(docs),
                                       lengths, terms, tfs)
    at = {p: n for n, p in enumerate(items.pairs)}
    got, scores, read = shard.best(items.groups[0], at, 10)
    plain, plain_scores, plain_read = shard.best(items.groups[0], at, 10, use_pairs=False)
    assert got.tolist() == plain.tolist() and scores.tolist() == plain_scores.tolist()
    assert read <= plain_read
    # the bounds themselves: a pair that never meets is bounded by the greater of the two
    assert items.pairs


def test_search_odd(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "again SAME", "x"), (2, None, "x"), (3, "", "x"), (4, "漢字 größe", "x"), (5, "lorem", "x")],
                                  "item_id long, text string, doc_id string")
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert found(lexical_search.search(docs, items)) == want
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


# --- hard negatives ----------------------------------------------------------------------

def brute_negatives(rows, every=100, k=5, scale=256):
    """rows (id, label, vector) that take part, ids distinct."""
    whole = [(i, y, [math.floor(scale * float(x)) for x in v]) for i, y, v in rows]
    out = []
    for i, y, v in whole:
        if i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in whole if j != i and len(w) == len(v)]
        best = sorted(((-s, j) for s, j, z in scored if z == y))[:k]
        for s, j in best:
            fits = sorted((-t, n) for t, n, z in scored if z != y and 80 * -s <= 100 * t <= 100 * -s)[:k]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def negatives(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def test_negatives_are_those_of_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert negatives(hard_negatives.op13_hard_negatives(spark, SF)) == sorted(con.execute(hard_negatives.ORACLE).fetchall())


@pytest.mark.parametrize("rows,tile", [(8, 3), (64, 2048)])
def test_negatives_of_clusters_ties_and_a_hot_label(spark, rows, tile):
    """Clustered vectors (blocks are left unread), many equal vectors, one frequent label."""
    rnd = random.Random(5)
    centres = [[rnd.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    data = []
    for i in range(500):
        c = centres[rnd.randrange(4)]
        v = c if i % 5 == 0 else [x + rnd.uniform(-0.1, 0.1) for x in c]
        data.append((i, 0 if rnd.random() < 0.5 else rnd.randrange(1, 5), v))
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3)
    got = hard_negatives.hard_negatives(df, every=20, rows=rows, tile=tile)
    assert negatives(got) == brute_negatives(data, every=20)


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (50, 7))
    block = np.concatenate([rng.integers(-300, 300, (40, 7)), rng.integers(200, 260, (40, 7))]).reshape(2, 40, 7)
    low, high = hard_negatives.bounds(x, block.min(axis=1), block.max(axis=1))
    scores = np.einsum("ad,brd->abr", x, block)
    assert (low <= scores.min(axis=2)).all() and (scores.max(axis=2) <= high).all()
    assert (high[:, 1] - low[:, 1] < high[:, 0] - low[:, 0]).all()  # a tight block has tight bounds
    big = np.array([[2 ** 40, -2 ** 40]])
    assert hard_negatives.products(big, np.array([[3, 1]])).tolist() == [[2 ** 41]]


def test_hilbert_curve_steps_to_neighbours():
    """Sorted by key, consecutive cells of the whole grid differ by one in one dimension."""
    for dims, bits in ((2, 4), (3, 3), (4, 2), (1, 4)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hard_negatives.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_best_breaks_ties_by_id():
    scores = np.array([[5, 7, 7, 7, 1], [hard_negatives.NOTHING, 2, hard_negatives.NOTHING, 2, 2]])
    i, j = hard_negatives.best(scores, np.array([9, 8, 3, 5, 1]), 2)
    assert list(zip(i, j)) == [(0, 2), (0, 3), (1, 4), (1, 3)]


def test_negatives_odd(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25, 1.0]
    rows = [(0, 1, v, "a"), (0, 1, v, "a"), (1, 1, v, "a"), (2, 2, v, "a"), (3, 2, [0.4, -0.25, 1.0], "a"), (4, None, v, "a"),
            (None, 1, v, "a"), (5, 1, None, "a"), (6, 1, [0.5, None, 1.0], "a"), (7, 2, [nan, 0.0, 0.0], "a"),
            (8, 2, [inf, 0.0, 0.0], "a"), (9, 1, [], "a"), (100, 2, [], "a"), (101, 2, [], None), (102, 1, [], None),
            (10, 1, [-0.5, 0.25, -1.0], "a"), (11, 3, [0.0, 0.0, 0.0], "a"), (200, 3, [0.0, 0.0, 0.0], "a"), (300, 9, v, "a")]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, rank string")
    sound = {i: (i, y, e) for i, y, e, _ in rows if i is not None and y is not None and e is not None
             and all(x is not None and math.isfinite(x) for x in e)}
    assert negatives(hard_negatives.hard_negatives(df)) == brute_negatives(sound.values())
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
