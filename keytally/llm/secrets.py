"""Secret scans: candidates by shape, false positives removed by a random forest.

Only DataFrame functions are used.  A text is cut into white-space words, and a word
into its longest runs of a secret's alphabet, so that quotes, brackets, ``=``, ``&``,
``#`` and the like end a run wherever they stand.  Past a ``name:`` in front and dots
behind, a run is a candidate if it has a digit, or mixed case without one, and
``SHORTEST`` or more characters, or ``NAMED_SHORTEST`` where a secret's name stands in
front.  Behind a secret's name and ``=`` or ``:``, in the word or in the two before it,
the whole value up to a quote, bracket, comma or space is the candidate instead, whatever
it is made of (``&`` ends it in an address); letters alone count from ``SHORTEST`` on.  So
is the password of ``scheme://user:password@host``.  A word can hold several candidates;
they share its ``word_index``.  A candidate is described by its length, how its characters change class, how much of it a word list
covers, whether it looks like part of a path, address or identifier, and by what stands
in front of it: the neighbouring words and the rest of its own, as its name.  A random
forest trained on labelled findings (``labelled_findings``) scores it; its trees are
one SQL expression inside the projection that reads the text, so nothing is shuffled
and a document's findings stay in its row.

The findings are described, not collected: each of ``KINDS`` is a shape (true secrets,
and the look-alikes that scanners report by mistake) filled from hashes of a running
number.

Defined cases: a null text has no candidates and stays null; an empty or candidate-free
text is unchanged; repeated secrets in a text are separate findings; null ids and
repeated rows are scanned like any others; an empty table gives an empty result;
other columns are ignored, and kept by ``redacted``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import free_name, stored, table

SHORTEST = 16
NAMED_SHORTEST = 8  # behind a secret's name
PER_KIND = 200
TREES, DEPTH = 15, 6
THRESHOLD = 0.5
SEED = 42
MASK = "[SECRET]"

# Words that names and placeholders are made of.
WORDS = ["the", "and", "for", "with", "that", "this", "from", "example", "sample", "test", "dummy", "fake", "your",
         "changeme", "placeholder", "http", "https", "www", "com", "org", "net", "html", "json", "index", "image",
         "file", "path", "user", "name", "config", "value", "data", "version", "release", "build", "number",
         "license", "licensed", "public", "commons", "general", "mail", "info", "document", "service", "client",
         "server", "manager", "factory", "request", "response", "handler", "controller", "default", "session",
         "abstract", "connection", "string", "object", "class", "method", "function", "address", "phone"]
SECRET_NAMES = ["password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth",
                "credential", "credentials", "private_key", "bearer", "authorization", "client_secret"]
DIGEST_NAMES = ["commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "revision", "etag", "uuid",
                "id", "isbn", "order", "invoice", "tracking", "card", "iban", "phone", "tel", "email", "mail"]


def _alternatives(words: list[str]) -> str:
    return "|".join(w.replace("-", "[-]") for w in words)


_BETWEEN = r"(?: is)?[\s=:\\\"'`>(\[{]*$"  # a name and its value
NAME = r"(?i)(?:^|[^a-z])(?:" + _alternatives(SECRET_NAMES) + ")"
NAMED = NAME + _BETWEEN
DIGEST = r"(?i)(?:^|[^a-z])(?:" + _alternatives(DIGEST_NAMES) + ")" + _BETWEEN.replace("=:", "=:#", 1)
LIST = "(?i)" + _alternatives(sorted(WORDS, key=len, reverse=True))
VARIED = r"(?s)[0-9]|^[^a-z]*+[a-z].*[A-Z]"  # tried from the first small letter only: linear
_ALPHABET = r"A-Za-z0-9+/_.~@:%\-"
#: What stands before a run, and the run; the last match takes the rest of the word.
RUN = r"(?s)(.*?)([" + _ALPHABET + "]{" + str(NAMED_SHORTEST) + r",}+(?:={1,2}(?![=\"'" + _ALPHABET + r"]))?|\z)"
_VALUE = r"[^\s\"'`<>,;()\[\]{}\\]"
_OPEN = r"[\"'`(\[{]*"
#: A named value inside a word; names may follow each other.
IN_WORD = (NAME + r"[\"'\])]*[=:]{1,3}" + _OPEN + "(?!(?:" + _alternatives(SECRET_NAMES) + r")[\"'\]]*[=:])("
           + _VALUE + "{" + str(NAMED_SHORTEST) + ",}+)")
#: The words before end with a name and its sign, or the word itself begins with the sign.
SIGN_BEFORE = NAME + r"(?: is)?[\"'`)\]}]*\s*[=:]{1,3}[\s\"'`(\[{]*$"
NAME_BEFORE = NAME + r"(?: is)?[\"'`)\]}]*\s*$"
AFTER = "^" + _OPEN + "(" + _VALUE + "{" + str(NAMED_SHORTEST) + ",}+)"
AFTER_SIGN = "^[=:]{1,3}" + _OPEN + "(" + _VALUE + "{" + str(NAMED_SHORTEST) + ",}+)"
#: The name and sign at the end of what stands before a value.
NAMED_TAIL = NAME + r"[\"'`)\]]*[=:]{1,3}[\"'`(\[{]*$"
IN_ADDRESS = r"://[^\s/:@]{1,100}+:([^\s/:@]{6,100})@"
#: A name in front of a run's value, or nothing between two colons.
RUN_NAME = r"^(?:[\-.]*[A-Za-z_][A-Za-z0-9_.\-]*)?$"

FEATURES = ["length", "digits", "upper", "lower", "other", "changes", "hexed", "covered", "path", "dotted", "dashed",
            "at", "named", "digest", "known", "distinct", "longest_letters"]


def _count(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")).cast("double")


def describe(value: Column, lead: Column) -> dict[str, Column]:
    """The features of candidate ``value`` after ``lead``: the words before and the
    candidate's own name."""
    n = F.length(value).cast("double")
    share = lambda outside: _count(value, outside) / n
    switched = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, r"[0-9]+", "\u0001"), r"[a-z]+", "\u0002"), r"[A-Z]+", "\u0003"), r"[^\u0001\u0002\u0003]+", "\u0004")
    flag = lambda c: c.cast("double")
    return {
        "length": F.least(n, F.lit(120.0)),
        "digits": share(r"[^0-9]"), "upper": share(r"[^A-Z]"), "lower": share(r"[^a-z]"),
        "other": share(r"[A-Za-z0-9]"),
        "changes": F.length(switched) / n,
        "hexed": flag(value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "covered": 1 - F.length(F.regexp_replace(value, LIST, "")) / n,
        "path": flag(value.rlike(r"^(?:[a-z]+://|[.~]?/)|/[a-z_.\-]+/|\.(?:html?|json|png|jpg|pdf|com|org|net)(?:$|/)")),
        "dotted": F.least(_count(value, r"[^.]"), F.lit(6.0)),
        "dashed": F.least(_count(value, r"[^\-_:]"), F.lit(8.0)),
        "at": flag(value.contains("@")),
        "named": flag(lead.rlike(NAMED)),
        "digest": flag(lead.rlike(DIGEST)),
        "known": flag(value.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abprs]-|"
                                  r"^sk_(?:live|test)_|^AIza[0-9A-Za-z_\-]{30,}$|^eyJ[A-Za-z0-9_\-]+\.")),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "longest_letters": F.array_max(F.transform(F.split(value, r"[^A-Za-z]+"), F.length)) / n,
    }


def _kinds(i: Column) -> list[tuple[int, Column, Column, Column]]:
    """(label, two words before, own name, value) of each kind of finding."""
    sha = lambda k, n: F.substring(F.sha2(F.concat_ws("-", i.cast("string"), F.lit(k)), 256), 1, n)
    any64 = lambda k, n: F.substring(F.regexp_replace(F.base64(F.unhex(F.concat(
        F.sha2(F.concat_ws("-", i.cast("string"), F.lit(k)), 256),
        F.sha2(F.concat_ws("+", i.cast("string"), F.lit(k)), 256)))), r"[\n=+/]", ""), 1, n)
    caps = lambda k, n: F.substring(F.upper(any64(k, 80)), 1, n)
    digits = lambda k, n: F.substring(F.regexp_replace(F.sha2(F.concat_ws("#", i.cast("string"), F.lit(k)), 512),
                                                       "[a-f]", ""), 1, n)
    pick = lambda words, k: F.element_at(F.array(*[F.lit(w) for w in words]),
                                         (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(len(words))) + 1).cast("int"))
    text, name, digest = pick(WORDS, "t"), pick(SECRET_NAMES, "n"), pick(DIGEST_NAMES, "d")
    two = F.concat_ws(" ", text, pick(WORDS, "u"))
    cap = F.initcap(text)
    none, set_to, long = F.lit(""), F.concat(name, F.lit("=")), F.lit(SHORTEST) + F.pmod(F.hash(i), F.lit(40))
    cut = lambda c: F.substr(c, F.lit(1), long.cast("int"))
    short = F.lit(NAMED_SHORTEST) + F.pmod(F.hash(i), F.lit(SHORTEST - NAMED_SHORTEST))
    brief = lambda c: F.substr(c, F.lit(1), short.cast("int"))
    letters = lambda k: F.translate(sha(k, 64), "0123456789", "ghilmnorst")
    return [
        (1, two, none, F.concat(F.lit("AKIA"), caps("a", 16))),
        (1, two, set_to, F.concat(F.lit("AKIA"), caps("b", 16))),
        (1, two, none, F.concat(F.lit("ghp_"), any64("c", 36))),
        (1, two, none, F.concat(F.lit("xoxb-"), digits("d", 11), F.lit("-"), any64("d", 24))),
        (1, two, none, F.concat(F.lit("sk_live_"), any64("e", 24))),
        (1, two, none, F.concat(F.lit("AIza"), any64("f", 35))),
        (1, two, none, F.concat(F.lit("eyJ"), any64("g", 30), F.lit("."), any64("h", 40), F.lit("."), any64("i", 40))),
        (1, two, set_to, cut(sha("j", 64))), (1, two, set_to, cut(any64("k", 80))),
        (1, F.concat(text, F.lit(" "), name, F.lit(" =")), none, cut(sha("l", 64))),
        (1, F.concat(text, F.lit(" "), name, F.lit(" =")), none, cut(any64("m", 80))),
        (1, F.concat(name, F.lit(" is")), F.concat(name, F.lit(":")), cut(any64("n", 80))),
        (1, two, none, F.concat(any64("o", 20), F.lit("/"), any64("p", 19))),
        (0, F.concat(text, F.lit(" "), digest), none, sha("q", 40)), (0, two, F.concat(digest, F.lit("=")), sha("r", 64)),
        (0, two, F.concat(digest, F.lit(":")), sha("s", 32)), (0, two, none, sha("t", 40)), (0, two, none, sha("u", 32)),
        (0, two, none, F.concat_ws("-", sha("v", 8), sha("w", 4), sha("x", 4), sha("y", 4), sha("z", 12))),
        (0, two, set_to, F.concat(pick(["your", "example", "changeme", "placeholder", "dummy", "test"], "A"),
                                  F.lit("_"), name, F.lit("_"), text, F.lit("_here"))),
        (0, two, set_to, F.concat(F.lit("EXAMPLE"), F.upper(text), F.lit("EXAMPLEKEY1"))),
        (0, two, set_to, F.rpad(F.lit("x"), 20, "x")),
        (0, two, none, F.concat(F.lit("https://www."), text, F.lit(".com/"), pick(WORDS, "B"), F.lit("/"), sha("C", 8))),
        (0, two, none, F.concat(F.lit("/usr/"), text, F.lit("/"), pick(WORDS, "D"), digits("D", 3), F.lit(".json"))),
        (0, two, none, F.concat(text, digits("E", 2), F.lit("."), pick(WORDS, "F"), F.lit("@"), pick(WORDS, "G"),
                                F.lit(".com"))),
        (0, two, none, F.concat(text, digits("E", 4), F.lit("@"), pick(WORDS, "H"), F.lit("."), pick(WORDS, "I"),
                                F.lit(".org"))),
        (0, two, none, digits("J", 16)), (0, F.concat(text, F.lit(" card")), none, digits("K", 16)),
        (0, two, none, F.concat_ws("-", digits("L", 4), digits("M", 4), digits("N", 4), digits("O", 4))),
        (0, two, none, F.concat(F.lit("+"), digits("P", 2), F.lit("-"), digits("Q", 3), F.lit("-"), digits("R", 8))),
        (0, two, none, F.concat(cap, F.initcap(pick(WORDS, "S")), F.initcap(pick(WORDS, "T")), F.lit("Service"))),
        (0, two, none, F.concat(text, F.lit("-"), pick(WORDS, "U"), F.lit("-"), pick(WORDS, "V"), F.lit("-"),
                                digits("V", 4))),
        (0, two, none, F.concat(text, F.lit("_"), pick(WORDS, "W"), F.lit("_"), pick(WORDS, "X"), digits("X", 2))),
        (0, two, none, F.concat_ws(":", F.lit("2024-01-01T10"), digits("Y", 2), digits("Z", 2))),
        (0, two, none, F.concat_ws(".", digits("1", 3), digits("2", 3), digits("3", 3), digits("4", 3), F.lit("8080"))),
        (0, two, F.concat(digest, F.lit(":")), cut(any64("5", 80))),
        # shorter than SHORTEST, behind a secret's name
        (1, two, set_to, brief(any64("6", 80))), (1, two, set_to, brief(sha("7", 64))),
        (1, F.concat(text, F.lit(" "), name, F.lit(" =")), none, brief(any64("8", 80))),
        (0, two, set_to, F.concat(pick(["changeme", "placeholder", "example", "password", "dummy"], "9"), digits("9", 2))),
        (0, two, set_to, F.concat(cap, F.initcap(pick(WORDS, "a1")))),
        (0, two, set_to, F.concat(F.lit("/"), text, F.lit("/"), pick(WORDS, "b1"), digits("b1", 1))),
        (0, F.concat(text, F.lit(" "), name, F.lit(":")), none, F.concat_ws("-", F.lit("2024"), digits("c1", 2), digits("d1", 2))),
        # whole values behind a name: with signs in them, or of letters alone
        (1, two, set_to, F.concat(brief(any64("e1", 80)), F.lit("!"), any64("f1", 3))),
        (1, two, set_to, F.concat(F.initcap(any64("g1", 4)), digits("g1", 1), F.lit("&"), any64("h1", 5), F.lit("#"))),
        (1, F.concat(text, F.lit(" "), name, F.lit(":")), none, F.concat(any64("i1", 5), F.lit("$"), any64("j1", 6))),
        (1, two, set_to, cut(letters("k1"))), (1, F.concat(text, F.lit(" "), name, F.lit(":")), none, cut(letters("l1"))),
        (1, two, F.lit("://user:password:"), brief(any64("m1", 80))), (1, two, F.lit("://user:password:"), brief(sha("n1", 64))),
        (0, two, set_to, F.concat(F.lit("$"), F.upper(text), F.lit("_"), F.upper(pick(WORDS, "o1")))),
        (0, two, set_to, F.concat(text, pick(WORDS, "p1"), pick(WORDS, "q1"))),
        (0, F.concat(text, F.lit(" "), name, F.lit(":")), none, F.concat(text, F.lit("."), pick(WORDS, "r1"), F.lit("."), name)),
    ]


def labelled_findings(spark: SparkSession, per_kind: int = PER_KIND) -> DataFrame:
    """Findings (label, before, name, value, lead), ``per_kind`` of each kind."""
    i = F.col("id")
    parts = []
    for k, (label, before, name, value) in enumerate(_kinds(i)):
        base = spark.range(k * per_kind, (k + 1) * per_kind, 1, 1)
        parts.append(base.select(F.lit(label).alias("label"), before.alias("before"), name.alias("name"),
                                 value.alias("value")))
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumn("lead", F.concat_ws(" ", "before", "name"))


def forest(spark: SparkSession, per_kind: int = PER_KIND, trees: int = TREES, depth: int = DEPTH):
    """A random forest over the features of the labelled findings."""
    found = stored(labelled_findings(spark, per_kind).coalesce(4), "findings")
    made = describe(F.col("value"), F.col("lead"))
    data = found.select(F.col("label").cast("double").alias("label"),
                        *[F.coalesce(made[c], F.lit(0.0)).alias(c) for c in FEATURES])
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(stored(data, "findings"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird") \
        .fit(data.select("label", "features"))


def _tree_column(node, feature) -> Column:
    """A tree of the fitted forest as nested WHENs giving the share of label 1."""
    if node.numDescendants() == 0:
        stats = list(node.impurityStats().stats())
        return F.lit(float(stats[1] / (stats[0] + stats[1])))
    split = node.split()
    return F.when(feature(split.featureIndex()) <= F.lit(float(split.threshold())),
                  _tree_column(node.leftChild(), feature)).otherwise(_tree_column(node.rightChild(), feature))


def score(model, features: Column) -> Column:
    """The forest's mean over its trees, for an array of feature values."""
    feature = lambda k: F.get(features, F.lit(k))
    trees = [_tree_column(t._java_obj.rootNode(), feature) for t in model.trees]
    return reduce(lambda a, b: a + b, trees) / F.lit(float(len(trees)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` reads it (an
    expression read inside a lambda is computed for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def names_of(run: Column) -> Column:
    """The names in front of a run's value, each with its colon; a scheme is none.  Told
    part by part, since Java matches a repeated group by recursion: its depth would grow
    with the word."""
    def length(parts: Column) -> Column:
        is_name = F.transform(parts, lambda p, i: (i < F.size(parts) - 1) & p.rlike(RUN_NAME)
                              & ~F.coalesce(F.get(parts, i + 1).startswith("//"), F.lit(False)))
        names = F.slice(parts, F.lit(1), F.array_position(is_name, F.lit(False)).cast("int") - 1)
        return F.aggregate(names, F.lit(0), lambda n, p: n + F.length(p) + 1)

    return F.substr(run, F.lit(1), _let(F.split(run, ":"), length))


def named_values(w: Column, b: Column) -> Column:
    """array<struct<v, l>>: the whole values of a word that stand behind a secret's name,
    the two words before included, or in an address, and what leads to them."""
    up_to = lambda t, e: F.call_function("substring_index", t, e, F.lit(1))
    end = F.when(w.contains("://") | w.contains("?"), F.lit("&")).otherwise(F.lit("\u0000"))
    own = lambda v: F.rtrim(up_to(v, end), F.lit(".:!?"))
    lead = F.concat(b, F.lit(" "))
    inside = F.transform(F.regexp_extract_all(w, F.lit(IN_WORD), F.lit(1)), lambda v: F.struct(
        own(v).alias("v"), F.concat(lead, F.regexp_extract(up_to(w, v), NAMED_TAIL, 0)).alias("l")))
    after = F.when(lead.rlike(SIGN_BEFORE), F.regexp_extract(w, AFTER, 1)) \
        .when(lead.rlike(NAME_BEFORE), F.regexp_extract(w, AFTER_SIGN, 1)).otherwise(F.lit(""))
    before = F.array(F.struct(own(after).alias("v"), F.concat(F.rtrim(lead), F.lit(" ")).alias("l")))
    address = F.transform(F.regexp_extract_all(w, F.lit(IN_ADDRESS), F.lit(1)), lambda v: F.struct(
        v.alias("v"), F.concat(lead, F.lit("://user:password:")).alias("l")))
    return F.concat(F.filter(F.concat(inside, before), lambda s: (F.length(s["v"]) >= NAMED_SHORTEST)
                              & (s["v"].rlike(VARIED) | (F.length(s["v"]) >= SHORTEST))), address)


def findings(text: Column, model) -> Column:
    """array<struct<word_index, value, score>> of every candidate of a text."""
    # each word with the two words in front of it
    placed = _let(F.split(text, r"[\x20\x09-\x0D]+"), lambda words: F.transform(
        F.filter(F.transform(words, lambda w, k: F.struct(k.alias("k"), w.alias("w"))),
                 lambda s: F.length(s["w"]) >= NAMED_SHORTEST),
        lambda s: F.struct(s["k"].alias("k"), s["w"].alias("w"),
                           F.concat_ws(" ", F.get(words, s["k"] - 2), F.get(words, s["k"] - 1)).alias("b"))))
    signed = lambda c: c.contains("=") | c.contains(":")
    some = F.filter(placed, lambda s: s["w"].rlike(VARIED) | signed(s["w"]) | signed(s["b"]))
    long = F.filter(some, lambda s: ((F.length(s["w"]) >= SHORTEST) & s["w"].rlike(VARIED))
                    | F.concat_ws(" ", s["b"], s["w"]).rlike(NAME) | s["w"].contains("://"))
    cut = F.transform(long, lambda s: F.struct(
        s["k"].alias("k"), s["b"].alias("b"), F.regexp_extract_all(s["w"], F.lit(RUN), F.lit(1)).alias("gaps"),
        F.regexp_extract_all(s["w"], F.lit(RUN), F.lit(2)).alias("runs"), named_values(s["w"], s["b"]).alias("values")))

    def candidates(cut: Column) -> Column:
        def run(s: Column, r: Column, j: Column) -> Column:
            # a name reaches back to the run before at most
            before = F.when(j == 0, F.concat(s["b"], F.lit(" "))).otherwise(F.get(s["runs"], j - 1))
            return F.struct(s["k"].alias("k"), F.rtrim(r, F.lit(".:")).alias("r"),
                            F.concat(before, F.get(s["gaps"], j)).alias("l"), s["values"].alias("values"))

        runs = F.flatten(F.transform(cut, lambda s: F.transform(s["runs"], lambda r, j: run(s, r, j))))
        named = F.transform(F.filter(runs, lambda s: s["r"].rlike(VARIED)), lambda s: F.struct(
            s["k"].alias("k"), s["r"].alias("r"), s["l"].alias("l"), s["values"].alias("values"),
            # behind a name, a colon in the value does not end another
            F.when(s["l"].rlike(NAMED), F.regexp_extract(s["r"], "^:*+", 0))
            .otherwise(names_of(s["r"])).alias("n")))
        valued = F.transform(named, lambda s: F.struct(
            s["k"].alias("k"), F.substr(s["r"], F.length(s["n"]) + 1).alias("v"), F.concat(s["l"], s["n"]).alias("l"),
            s["values"].alias("values")))
        shaped = F.filter(valued, lambda s: s["v"].rlike(VARIED) & (
            (F.length(s["v"]) >= SHORTEST) | ((F.length(s["v"]) >= NAMED_SHORTEST) & s["l"].rlike(NAMED)))
            # a run in, or around, a whole value is no candidate of its own
            & ~F.exists(s["values"], lambda x: x["v"].contains(s["v"]) | s["v"].contains(x["v"])))
        return F.concat(
            F.transform(shaped, lambda s: F.struct(s["k"].alias("k"), s["v"].alias("v"), s["l"].alias("l"))),
            F.flatten(F.transform(cut, lambda s: F.transform(s["values"], lambda x: F.struct(
                s["k"].alias("k"), x["v"].alias("v"), x["l"].alias("l"))))))

    def scored(s: Column) -> Column:
        made = describe(s["v"], s["l"])
        return F.struct(s["k"].alias("k"), s["v"].alias("v"),
                        F.array(*[F.coalesce(made[c], F.lit(0.0)) for c in FEATURES]).alias("f"))

    return F.transform(F.transform(_let(cut, candidates), scored), lambda s: F.struct(
        s["k"].alias("word_index"), s["v"].alias("value"), score(model, s["f"]).alias("score")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """One row per candidate: id, ``word_index``, ``value``, ``score``, ``is_secret``."""
    model = model or forest(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), findings(F.col(text_col), model).alias("found"))
    return rows.select("id", F.explode("found").alias("x")).select(
        F.col("id").alias(id_col), "x.word_index", "x.value", "x.score",
        (F.col("x.score") >= THRESHOLD).alias("is_secret"))


def redacted(docs: DataFrame, text_col: str = "text", model=None) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``MASK``, columns as they are."""
    model = model or forest(docs.sparkSession)
    found = free_name(docs, "found_secrets")
    secrets = F.transform(F.filter(findings(F.col(text_col), model), lambda s: s["score"] >= THRESHOLD),
                          lambda s: s["value"])
    # longest first: a secret that is part of another does not break it up
    ordered = F.reverse(F.array_sort(F.transform(F.array_distinct(F.col(found)),
                                                 lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))

    def mask(t: Column, s: Column) -> Column:
        # a short one only where it stands by itself
        alone = F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), s["v"], F.lit(r"\E(?![A-Za-z0-9])"))
        return (F.when(s["n"] < SHORTEST, F.regexp_replace(t, alone, F.lit(MASK)))
                .otherwise(F.replace(t, s["v"], F.lit(MASK))))

    masked = F.aggregate(ordered, F.col(text_col), mask)
    return (docs.withColumn(found, secrets)
            .withColumn(text_col, F.when(F.size(found) > 0, masked).otherwise(F.col(text_col))).drop(found))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document; the value itself is given as a hash."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "word_index", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"),
        "score", "is_secret")
