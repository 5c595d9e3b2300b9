"""Personal data: base patterns, and bootstrapped contextual extraction.

DataFrame functions only.  Base spans come from four fixed patterns, leftmost
and non-overlapping per kind, dropped when a check fails.  The method then
looks at identifier-like tokens (those with a digit or an at sign) and the
words to their left:

* the base spans are seeds; the word to the left of a token is its pattern;
  (pattern, token) pairs with their counts form a graph;
* scores go round that graph ``ROUNDS`` times: a pattern's is the share of
  all its occurrences in the corpus that stand before trusted tokens (with
  two doubtful occurrences added), a token's is that of its best pattern,
  seeds keep one.  So "the" is no pattern, however many seeds it precedes;
* patterns of at least ``SUPPORT`` different seeds and a score of ``TRUST``
  mark tokens of ``DIGITS`` digits or more (or an at sign): spans of kind
  ``context``.  A token that a base span covers, or that has the form of a
  kind but failed its check (a card number's digits, say), is never marked.

Words and pairs are counted before they are shuffled, so a word that stands
before a third of all tokens is one row per task and token.  Regular expressions are
written so that no text, however long, makes them try a start twice.

Defined results: null text counts as empty.  Positions are code points, ends
exclusive.  Repeated ids are separate rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import register, store, table, text_or_empty

# The base patterns.  Possessive repeats and the looks behind
# only save time: a start inside a run fails where the run's start fails,
# unless the run was entered by the match before (\\G).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
ROUNDS, SUPPORT, TRUST, DIGITS = 3, 5, 0.5, 4


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _matches(text: Column, pattern: str, some: Column) -> tuple[Column, Column]:
    """(matches, lengths of the text before, between and after them); empty where ``some`` is false."""
    found = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(some, F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))).otherwise(F.array().cast("array<int>"))
    return found, gaps


def _start(found: Column, gaps: Column, i: Column) -> Column:
    """Where match i (from 0) starts."""
    return _sum(F.slice(gaps, F.lit(1), i + 1)) + _sum(F.transform(F.slice(found, F.lit(1), i), lambda m: F.char_length(m)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.char_length(_digits(value))
    if kind == "ip":
        bare = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(bare, lambda p: (F.char_length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _in_form(kind: str, value: Column) -> Column:
    """Whether a match looks like its kind, checks aside."""
    return F.char_length(_digits(value)).between(12, 19) if kind == "card" else F.lit(True)


def _base(kind: str, number: int, found: Column, gaps: Column) -> tuple[Column, Column]:
    """Valid spans of one kind, and those in form that failed the check."""

    def span(value: Column, i: Column) -> Column:
        start = _start(found, gaps, i)
        return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + F.char_length(value)).alias("stop"), value.alias("value"))

    def bare(spans_: Column) -> Column:
        return F.transform(spans_, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))

    every = F.transform(found, span)
    refused = F.filter(every, lambda s: ~_valid(kind, s["value"]) & _in_form(kind, s["value"]))
    return bare(F.filter(every, lambda s: _valid(kind, s["value"]))), bare(refused)


def _likely(text: Column) -> dict[str, tuple[str, Column]]:
    """Pattern of each kind and a cheap test that it can match at all."""
    return {
        "email": (EMAIL, text.contains("@")),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
        "card": (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        "phone": (PHONE, text.contains("+")),
    }


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, tokens): base spans (start, kind, stop) in order, and tokens with their left words."""
    text = F.col("text")
    docs = docs.select("doc_id", text_or_empty("text").alias("text"))
    cols = []
    for kind, (pattern, some) in _likely(text).items():
        found, gaps = _matches(text, pattern, some)
        cols += [found.alias(f"{kind}_found"), gaps.alias(f"{kind}_gaps")]
    some = text.rlike("[0-9@]")
    found, gaps = _matches(text, TOKEN, some)
    before = F.when(some, F.transform(F.split(text, TOKEN, -1), lambda p: F.right(p, F.lit(80)))).otherwise(F.array().cast("array<string>"))
    raw = docs.select("doc_id", *cols, found.alias("token_found"), gaps.alias("token_gaps"), before.alias("token_before"))
    parts = [_base(kind, k, F.col(f"{kind}_found"), F.col(f"{kind}_gaps")) for k, kind in enumerate(KINDS[:4])]
    found, gaps, before = F.col("token_found"), F.col("token_gaps"), F.col("token_before")

    def token(m: Column, i: Column) -> Column:
        near = F.lower(F.regexp_extract(F.element_at(before, i + 1), r"(\S+)\s*$", 1))
        start = _start(found, gaps, i)
        return F.struct(start.alias("start"), (start + F.char_length(m)).alias("stop"), m.alias("token"), near.alias("near"))

    return raw.select(
        "doc_id", F.array_sort(F.concat(*[p[0] for p in parts])).alias("base"), F.concat(*[p[1] for p in parts]).alias("refused"),
        F.transform(found, token).alias("tokens"),
    )


def graph(scanned: DataFrame) -> DataFrame:
    """(row, start, stop, token, pattern, seed, closed) of every token that has a word to its left."""
    t = scanned.select("row", "base", "refused", F.explode("tokens").alias("t")).select("row", "base", "refused", "t.*")

    def overlaps(spans_: str) -> Column:
        return F.exists(spans_, lambda b: (b["start"] < F.col("stop")) & (b["stop"] > F.col("start")))

    begins = F.exists("base", lambda b: (b["start"] >= F.col("start")) & (b["start"] < F.col("stop")))
    return t.filter("near <> ''").select(
        "row", "start", "stop", "token", F.col("near").alias("pattern"), begins.alias("seed"), (overlaps("base") | overlaps("refused")).alias("closed")
    )


def occurrences(docs: DataFrame) -> DataFrame:
    """(pattern, total) of every word of the corpus."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("pattern"))
    return words.groupBy("pattern").agg(F.count("*").alias("total"))


def trusted(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(pattern, trust) of the patterns that mark unseen identifiers."""
    edges = tokens.groupBy("pattern", "token").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.max("closed").alias("closed"))
    edges = store(edges, "pii-graph")
    supported = edges.groupBy("pattern").agg(F.count(F.when(F.col("seed"), 1)).alias("seeds")).filter(F.col("seeds") >= SUPPORT)
    supported = store(words.join(supported, "pattern").select("pattern", "total"), "pii-patterns")
    edges = edges.join(supported, "pattern")  # no other pattern can mark, or lend trust
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for step in range(ROUNDS):
        patterns = scored.groupBy("pattern").agg((F.sum(F.col("n") * F.col("score")) / (F.max("total") + 2)).alias("trust"))
        if step == ROUNDS - 1:
            break
        best = edges.join(patterns, "pattern").groupBy("token").agg(F.max("trust").alias("best"))
        doubt = F.when(F.col("seed"), 1.0).when(F.col("closed"), 0.0).otherwise(F.coalesce("best", F.lit(0.0)))
        scored = store(edges.join(best, "token", "left").withColumn("score", doubt).drop("best"), "pii-scores")
    return patterns.filter(F.col("trust") >= TRUST)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    scanned = store(spans(docs).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    tokens = graph(scanned)
    fresh = tokens.filter("NOT closed").filter((F.char_length(_digits(F.col("token"))) >= DIGITS) | F.col("token").contains("@"))
    named = fresh.join(trusted(tokens, occurrences(docs)), "pattern", "left_semi")
    more = named.groupBy("row").agg(F.collect_list(F.struct(F.col("start"), F.lit(4).alias("kind"), F.col("stop"))).alias("found"))  # spans of one text
    every = F.array_sort(F.concat("base", F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,stop:int>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans_: Column) -> Column:
        return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select("row", "doc_id", "base").join(more, "row", "left").select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"),
    )


@register("op9_pii")
def op9(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))
