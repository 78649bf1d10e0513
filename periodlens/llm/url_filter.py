"""URL filter: rules first, else naive Bayes over words of host and path.

Names of hosts run words together. A unigram model of words, counted over all
pages' titles and URLs, splits each run of letters into its likeliest words (Viterbi). A
multinomial naive Bayes model scores the words of host and path. Its two
classes are taught by a list of terms: a URL with one of them among its words
is an example to block, any other one to allow; the model then also weighs
the words that keep company with the terms.

Hosts, runs of letters and paths are each worked on once, however many pages
share them. A run meets the words it can contain by a join on substrings, so
the vocabulary may have any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.session import pin

LONGEST_WORD = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed list of terms.
BLOCK_TERMS = (
    "casino poker gamble gambling jackpot slots bet bets betting lottery pills pharmacy viagra cialis adult porn xxx sex escort "
    "spam ads advert tracker track clickbait malware phishing warez torrent crack keygen replica payday loan loans"
).split()
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, or nulls. Rules are given by the caller, so they are literals."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("[a-z]+"), F.lit(0))


def count_words(pages: DataFrame, terms: Sequence[str], least_hosts: int = 3) -> DataFrame:
    """``word`` and ``n``: words of titles and paths over all pages, runs of letters that ``least_hosts`` hosts or more
    have (a run of one host may be a whole run-together name), and each term."""
    host, path = split_url(F.col("url"))
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    found = F.concat(*[F.coalesce(_words(part), F.array().cast("array<string>")) for part in (path, title)])
    counted = pages.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    hosts = pages.select(host.alias("host")).distinct().select(F.explode(F.array_distinct(_words(F.col("host")))).alias("word"))
    common = hosts.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_hosts)
    taught = pages.sparkSession.createDataFrame([(term, 1) for term in terms], "word string, n long")
    return (
        counted.unionByName(common)
        .unionByName(taught)
        .where(F.length("word") <= LONGEST_WORD)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def best_split(run: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of ``run``. ``known``: count of the word at (start, length).

    An unknown word of length ``l`` has probability ``1 / (total * 10 ** l)``.
    Of equal splits the one with the longer last word wins.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(run) + 1):
        options = []
        for length in range(min(LONGEST_WORD, end), 0, -1):
            n = known.get((end - length, length), 0)
            cost = math.log(total) - math.log(n) if n else math.log(total) + length * math.log(10)
            options.append((best[end - length][0] + cost, -length))
        cost, length = min(options)
        best.append((cost, -length))
    words, end = [], len(run)
    while end:
        words.append(run[end - best[end][1] : end])
        end -= best[end][1]
    return words[::-1]


def segment(runs: DataFrame, counted: DataFrame) -> DataFrame:
    """``run`` and its ``words`` for each distinct ``run`` of letters."""
    total = int(counted.agg(F.sum("n")).first()[0] or 1)
    pieces = runs.select(
        "run",
        F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start"),
    ).select(
        "run",
        "start",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("run") - F.col("start") + 1)),
                lambda size: F.substring(F.col("run"), F.col("start"), size),
            )
        ).alias("word"),
    )
    met = (
        pieces.join(counted, "word")
        .groupBy("run")
        .agg(F.collect_list(F.struct((F.col("start") - 1).alias("start"), F.length("word").alias("size"), "n")).alias("known"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["run"].to_pylist()
            words = [
                best_split(run, {(k["start"], k["size"]): k["n"] for k in known or []}, total)
                for run, known in zip(names, batch["known"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))], ["run", "words"])

    return runs.join(met, "run", "left").mapInArrow(split, "run string, words array<string>")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, terms: Sequence[str] = BLOCK_TERMS
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` for each row of ``page_id``, ``url``, ``html``.

    ``score`` is the log odds of blocking by naive Bayes, given for every row;
    it decides where no rule fits: block above 0. A URL without words has the
    odds of the classes. Null or repeated page_ids are rows like others; other
    columns are ignored.
    """
    counted = pin(count_words(pages, terms), "word-counts")
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = pin(urls.withColumn("trail", F.array_join(_words(F.col("path")), " ")), "urls")
    kinds = pin(urls.groupBy("host", "trail").agg(F.count("*").alias("urls")), "kinds")
    runs = kinds.select("host").distinct().select("host", F.explode(_words(F.col("host"))).alias("run"))
    split = pin(segment(runs.select("run").distinct(), counted), "segments")
    host_words = pin(runs.join(split, "run").select("host", F.explode("words").alias("word")), "host-words")
    trails = kinds.select("trail").distinct()
    trail_words = pin(
        trails.select("trail", F.explode(F.split("trail", " ")).alias("word")).where("word <> ''"), "trail-words"
    )
    blocked = F.max(F.col("word").isin(list(terms))).alias("listed")
    taught = (
        kinds.join(host_words.groupBy("host").agg(blocked), "host", "left")
        .join(trail_words.groupBy("trail").agg(blocked.alias("trail_listed")), "trail", "left")
        .withColumn(
            "bad", (F.coalesce("listed", F.lit(False)) | F.coalesce("trail_listed", F.lit(False))).cast("long") * F.col("urls")
        )
    )
    taught = pin(taught.select("host", "trail", "urls", "bad"), "taught")
    by_class = [F.sum("bad").alias("bad"), F.sum(F.col("urls") - F.col("bad")).alias("good")]
    by_host = taught.groupBy("host").agg(*by_class)
    by_trail = taught.groupBy("trail").agg(*by_class)
    tallies = pin(
        host_words.join(by_host, "host")
        .select("word", "bad", "good")
        .unionByName(trail_words.join(by_trail, "trail").select("word", "bad", "good"))
        .groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")),
        "tallies",
    )
    sums = tallies.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
    bad, good, words = (int(x or 0) for x in sums)
    prior = taught.agg(F.sum("bad"), F.sum("urls")).first()
    blocks, every = (int(x or 0) for x in prior)
    odds = math.log((blocks + 1) / (every - blocks + 1))
    weight = F.log((F.col("bad") + 1) / float(bad + words + 1)) - F.log((F.col("good") + 1) / float(good + words + 1))
    weights = tallies.select("word", weight.alias("weight"))
    host_scores = pin(
        host_words.join(weights, "word").groupBy(F.col("host").alias("_host")).agg(F.sum("weight").alias("host_score")), "host-scores"
    )
    trail_scores = pin(
        trail_words.join(weights, "word").groupBy(F.col("trail").alias("_trail")).agg(F.sum("weight").alias("trail_score")),
        "trail-scores",
    )
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    score = F.lit(odds) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("trail_score", F.lit(0.0))
    return (
        urls.join(host_scores, F.col("host") == F.col("_host"), "left")
        .join(trail_scores, F.col("trail") == F.col("_trail"), "left")
        .withColumn("score", score)
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
            "score",
        )
    )
