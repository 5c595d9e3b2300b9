"""URL filters: rules first, then naive Bayes on segmented host and path words.

Rules are (host, path) pairs; the longest that fits a url decides.  Urls that
no rule judges get the verdict of a multinomial naive Bayes model learnt from
those that rules judge.  Its tokens are the words of the host and the parts
of the path (digits as ``#``).  Host labels are cut into words by the most
probable split under a unigram model of the pages' visible words: all
substrings of the distinct labels join the word counts, and a Viterbi pass
per label picks the split.  Unknown strings of n letters have probability
10 / (N * 10^n), N the number of words counted.

Counts, labels and tokens stay distributed; the driver sees four totals.  A
host with a third of all pages is one row of counts per task, and one row of
the table its pages join.

Defined results: null urls and urls without ``://`` have empty host and path
and get the model's prior verdict; with nothing to learn from, or a tie, the
verdict is allow.  Null html teaches no words.  A run of more than ``LABEL``
letters is no valid label and stays whole; words of more than ``WORD``
letters are not counted.  Repeated rows count as often as they come.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import register, rows_in, store, table

# The rules.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: The longest label a host name can have (RFC 1035); a word inside one is no longer.
LABEL = WORD = 63


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; ASCII letters of the host in lower case."""
    pattern = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: len(r[0])):  # later ones win: the longest
        at, _, rest = name.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) of the visible words of all pages."""
    visible = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^<>]*>", " "))
    words = pages.select(F.explode(F.split(visible, r"[^\p{L}]+")).alias("word")).filter(F.char_length("word").between(1, WORD))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a label; known: (start, length) -> count."""
    if len(label) > LABEL:
        return [label]
    log_n = math.log(max(total, 1))
    best: list[tuple[float, int]] = [(0.0, 0)] + [(-math.inf, 0)] * len(label)
    for end in range(1, len(label) + 1):
        for start in range(end):
            n = known.get((start, end - start), 0)
            p = math.log(n) - log_n if n else math.log(10) * (1 - (end - start)) - log_n
            if best[start][0] + p > best[end][0]:
                best[end] = (best[start][0] + p, start)
    words, end = [], len(label)
    while end:
        words.append(label[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


def segmented(labels: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(label, words) of distinct labels."""
    short = labels.filter(F.char_length("label") <= LABEL)
    starts = short.select("label", F.explode(F.sequence(F.lit(1), F.char_length("label"))).alias("start"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(WORD), F.char_length("label") - F.col("start") + 1))
    parts = starts.select("label", "start", F.explode(lengths).alias("length"))
    parts = parts.withColumn("word", F.substr(F.col("label"), F.col("start"), F.col("length")))
    found = parts.join(words, "word").groupBy("label").agg(F.collect_list(F.struct("start", "length", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(rows_in(iter([batch])))
            split = [best_split(label, {(f["start"] - 1, f["length"]): f["n"] for f in got or []}, total) for label, got in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))], names=["label", "words"])

    return labels.join(found, "label", "left").select("label", "found").mapInArrow(run, "label string, words array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_odds) of every page."""
    host, path = split_url(F.col("url"))
    parts = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    shape = F.array_join(F.transform(parts, lambda t: F.regexp_replace(t, "[0-9]+", "#")), " ")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_columns(F.col("host"), F.col("path"), rules)
    urls = store(urls.select("page_id", "host", "path", shape.alias("shape"), rule.alias("rule"), says.alias("says")), "urls")

    words = store(word_counts(pages.select("html")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    hosts = urls.select("host").distinct()
    host_labels = hosts.select("host", F.explode(F.filter(F.split("host", r"[^\p{L}]+"), lambda t: t != "")).alias("label"))
    split = segmented(host_labels.select("label").distinct(), words, total)
    of_host = store(host_labels.join(split, "label").select("host", F.explode("words").alias("token")), "host-words")
    of_shape = urls.select("shape").distinct().select("shape", F.explode(F.filter(F.split("shape", " "), lambda t: t != "")).alias("token"))
    of_host = of_host.withColumn("token", F.concat(F.lit("h:"), "token"))
    of_shape = of_shape.withColumn("token", F.concat(F.lit("p:"), "token"))

    judged = urls.filter("says IS NOT NULL")
    sides = [F.sum(F.when(F.col("says") == s, F.col("n")).otherwise(0)).alias(s) for s in ("block", "allow")]
    by_host = judged.groupBy("host", "says").agg(F.count("*").alias("n")).join(of_host, "host").groupBy("token").agg(*sides)
    by_shape = judged.groupBy("shape", "says").agg(F.count("*").alias("n")).join(of_shape, "shape").groupBy("token").agg(*sides)
    counts = store(by_host.unionByName(by_shape), "tokens")
    sums = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("v")).first()
    class_sizes = {r["says"]: r["count"] for r in judged.groupBy("says").count().collect()}  # two rows
    block, allow, v = sums["block"] or 0, sums["allow"] or 0, sums["v"]
    prior = math.log((class_sizes.get("block", 0) + 1) / (class_sizes.get("allow", 0) + 1))
    unseen = math.log((allow + v + 1) / (block + v + 1))  # of a token that no judged url has
    odds = counts.select("token", (F.log(F.col("block") + 1.0) - F.log(F.col("allow") + 1.0) + unseen).alias("odds"))

    def scored(of: DataFrame, key: str, name: str) -> DataFrame:
        return of.join(odds, "token", "left").groupBy(key).agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias(name))

    total_odds = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    return (
        urls.join(scored(of_host, "host", "host_odds"), "host", "left")
        .join(scored(of_shape, "shape", "path_odds"), "shape", "left")
        .withColumn("block_odds", total_odds)
        .select("page_id", "host", "path", "rule",
                F.coalesce("says", F.when(F.col("block_odds") > 0, "block").otherwise("allow")).alias("verdict"), "block_odds")
    )


@register("op2_urls")
def op2(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
