"""URL filter: rules for hosts and paths, and for what they leave open a naive Bayes over segmented words.

A host's labels are cut at hyphens and the like, and each piece is segmented by
the Viterbi algorithm over unigrams: the words of the pages' own text and of
hyphenated hosts, and the seed words. Only substrings of the distinct pieces are
joined to the unigram counts; the dictionary is never gathered in one place.

The classes are learnt from the table itself: a host whose segmented words
include a seed word starts as blocked, every other as allowed. A multinomial
naive Bayes over the words of host and path, with add-one smoothing, is trained on
all URLs with these marks and then judges them, so words that stand with seed
words count against hosts that have none.

Scores are found once for each distinct host and path word list and joined to
the URLs. A null URL, or one without `://`, has an empty host and path: no rule
fits it and it is allowed unless its prior says otherwise. Repeated pages are
answered row by row; an empty table gives no rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import Steps, sent_if_small

# Rules of the filter, (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Words that mark a host as unwanted.
SEEDS = ["ads", "adult", "bet", "bets", "betting", "bitcoin", "casino", "cialis", "clickbait", "coupon", "crack",
         "escort", "forex", "gambling", "hack", "jackpot", "keygen", "lottery", "malware", "payday", "pharmacy",
         "phishing", "pill", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "track",
         "tracker", "tracking", "viagra", "warez", "webcam", "xxx"]

#: Letters of the longest dictionary word; longer stretches are cut.
LONGEST = 24
#: Count that a seed word has beyond its own.
SEED_COUNT = 100

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def segmented(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """The most likely words of a piece; a word that is not counted gets less with each letter."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        choices = []
        for start in range(max(0, end - LONGEST), end):
            word = piece[start:end]
            n = counts.get(word)
            chance = math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)
            choices.append((best[start][0] + chance, start))
        best.append(max(choices))
    words, end = [], len(piece)
    while end:
        start = best[end][1]
        words.append(piece[start:end])
        end = start
    return words[::-1]


def _segmenting(total: int):
    def run(batches):
        for batch in batches:
            words = [segmented(p, {s["word"]: s["n"] for s in c or ()}, total) for p, c in
                     zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist())]
            yield pa.RecordBatch.from_pydict({"piece": batch.column("piece"),
                                              "words": pa.array(words, pa.list_(pa.string()))})
    return run


def unigrams(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(word, n) of the ASCII words in the text of pages and in hyphenated hosts, and the seeds."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word"))
    hyphened = hosts.where(F.col("host").contains("-")).select(
        F.explode(F.split("host", "[^a-z]+")).alias("word"))
    seeds = pages.sparkSession.createDataFrame([(s, SEED_COUNT) for s in SEEDS], "word string, n long")
    counted = words.unionByName(hyphened).where(
        F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
    return counted.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def host_words(steps: Steps, pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, words) of each distinct host."""
    pieces = hosts.select("host", F.posexplode(F.split("host", r"[^a-z0-9]+")).alias("at", "piece")).where("piece <> ''")
    pieces = steps.keep(pieces)
    counts = steps.keep(unigrams(pages, hosts))
    total = counts.agg(F.sum("n")).first()[0] or 1
    distinct = pieces.select("piece").distinct()
    starts = F.sequence(F.lit(1), F.length("piece"))
    parts = (distinct.select("piece", F.explode(starts).alias("start"))
             .select("piece", "start", F.explode(F.sequence(
                 F.lit(1), F.least(F.lit(LONGEST), F.length("piece") - F.col("start") + 1))).alias("size"))
             .select("piece", F.expr("substring(piece, start, size)").alias("word")).distinct())
    known = parts.join(counts, "word").groupBy("piece").agg(F.collect_list(F.struct("word", "n")).alias("counts"))
    words = distinct.join(known, "piece", "left").mapInArrow(
        _segmenting(total), "piece string, words array<string>")
    return (pieces.join(words, "piece").groupBy("host")
            .agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
            .select("host", F.flatten(F.col("parts.words")).alias("words")))


def path_words(path: Column) -> Column:
    """Lower-case words of a path, a number standing as `#`."""
    parts = F.split(F.lower(path), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda x: x != ""),
                       lambda x: F.when(x.rlike(r"^\p{N}+$"), F.lit("#")).otherwise(x))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Host, path, rule and verdict of each page, the words of its host and its score."""
    steps = Steps(pages.sparkSession, "url-filters")
    urls = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    urls = steps.keep(urls.withColumn("shape", F.array_join(path_words(F.col("path")), " ")))
    hosts = steps.keep(urls.groupBy("host").agg(F.count("*").alias("n")))
    segments = steps.keep(host_words(steps, pages, hosts.select("host")))
    seeds = F.array(*map(F.lit, SEEDS))
    hosts = steps.keep(hosts.join(segments, "host", "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>")))
        .withColumn("marked", F.arrays_overlap("words", seeds).cast("int")))
    pairs = urls.groupBy("host", "shape").agg(F.count("*").alias("n"))
    shapes = steps.keep(pairs.join(hosts.select("host", "marked"), "host").groupBy("shape", "marked")
                        .agg(F.sum("n").alias("n")))
    used = hosts.select("marked", "n", F.explode("words").alias("word")).unionByName(
        shapes.select("marked", "n", F.explode(F.split("shape", " ")).alias("word")).where("word <> ''"))
    counts = steps.keep(used.groupBy("word").agg(
        F.sum(F.when(F.col("marked") == 1, F.col("n")).otherwise(0)).alias("blocked"),
        F.sum(F.when(F.col("marked") == 0, F.col("n")).otherwise(0)).alias("allowed")))
    sums = counts.agg(F.count("*").alias("v"), F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).first()
    prior = hosts.agg(F.sum(F.col("n") * F.col("marked")).alias("b"),
                      F.sum(F.col("n") * (1 - F.col("marked"))).alias("a")).first()
    v, b, a = sums["v"], sums["b"] or 0, sums["a"] or 0
    odds = counts.select("word", (F.log((F.col("blocked") + 1) / F.lit(b + v or 1))
                                  - F.log((F.col("allowed") + 1) / F.lit(a + v or 1))).alias("odds"))
    base = math.log(((prior["b"] or 0) + 1) / ((prior["a"] or 0) + 1))

    def scored(keys: DataFrame, key: str, words: Column, name: str) -> DataFrame:
        each = keys.select(key, F.explode(words).alias("word")).join(sent_if_small(odds), "word")
        return steps.keep(each.groupBy(key).agg(F.sum("odds").alias(name)))

    by_host = scored(hosts, "host", F.col("words"), "host_odds")
    by_shape = scored(shapes.select("shape").distinct(), "shape", F.split("shape", " "), "path_odds")
    hosts = steps.keep(hosts.select("host", "words").join(by_host, "host", "left"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    score = 1 / (1 + F.exp(-(F.lit(base) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)))))
    return (urls.join(sent_if_small(hosts), "host").join(sent_if_small(by_shape), "shape", "left")
            .withColumn("found", rule).withColumn("score", score)
            .select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
                    F.array_join("words", " ").alias("words"), "score"))
