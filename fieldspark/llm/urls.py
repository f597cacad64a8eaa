"""URL filtering: rules first, then naive Bayes over segmented host and path tokens.

Host labels are concatenations of words. A unigram Viterbi pass splits them into the most likely
words, with word frequencies counted over the text of all pages. The urls that a rule decides are
the training set of a multinomial naive Bayes model, which judges the others by the words of their
host and the tokens of their path.

Hosts and path patterns are handled once each, whatever the number of urls: a label meets only
those words that occur in it, by a join, so no dictionary is sent to the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import checkpointed, text_bytes

LONGEST_WORD = 24
_TAG = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)\s*>|<[^>]*>", re.S | re.I)
_WORD = re.compile(rb"[a-z]+")
_ABC = "abcdefghijklmnopqrstuvwxyz"
_SMOOTHING = 1.0


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case;
    empty without ``://`` or for a null."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _ABC.upper(), _ABC), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n) of the words of ``a`` to ``z``, up to ``LONGEST_WORD`` long, in the text of all pages."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for html in text_bytes(batch.column(0)):
                counts.update(_WORD.findall(_TAG.sub(b" ", html).lower()))
            kept = {w.decode(): n for w, n in counts.items() if len(w) <= LONGEST_WORD}
            yield pa.record_batch({"word": pa.array(list(kept), pa.string()), "n": pa.array(list(kept.values()), pa.int64())})

    return pages.select(html_col).mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def segmented(label: str, found: list[tuple[int, int, int]], total: int) -> list[str]:
    """The most likely words of a label, from (place, length, count) of the known words in it.

    An unknown stretch is as likely as ten words seen once, divided by ten for every letter. Ties
    go to the split whose last word is longest.
    """
    by_place: dict[int, list[tuple[int, float]]] = {}
    for place, size, n in found:
        by_place.setdefault(place, []).append((size, math.log(n / total)))
    best = [0.0] + [-math.inf] * len(label)
    back = [0] * (len(label) + 1)
    for place in range(len(label)):
        known = dict(by_place.get(place, ()))
        for size in range(1, min(LONGEST_WORD, len(label) - place) + 1):
            weight = known.get(size, math.log(10 / max(10, total)) - size * math.log(10))
            if best[place] + weight > best[place + size]:
                best[place + size], back[place + size] = best[place] + weight, place
    words, at = [], len(label)
    while at:
        words.append(label[back[at] : at])
        at = back[at]
    return words[::-1]


def segment_labels(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(label, tokens) of different labels of ``a`` to ``z``. A label meets its own parts alone."""
    total = words.agg(F.sum("n")).first()[0] or 1
    size = F.length("label")
    parts = labels.select("label", F.explode(F.sequence(F.lit(0), size - 1)).alias("place")).select(
        "label", "place", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), size - F.col("place")))).alias("size")
    )
    parts = parts.withColumn("word", F.expr("substr(label, place + 1, size)"))
    known = parts.join(words, "word").groupBy("label").agg(F.collect_list(F.struct("place", "size", "n")).alias("found"))

    def split(label: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([
            segmented(word, [(r["place"], r["size"], r["n"]) for r in (rows if rows is not None else ())], total)
            for word, rows in zip(label, found)
        ])

    return labels.join(known, "label", "left").select("label", F.pandas_udf(split, "array<string>")("label", "found").alias("tokens"))


def rules_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, text like ``net/es/``) as rows (host, path, rule, verdict)."""
    rows = [(text.partition("/")[0], "/" + text.partition("/")[2], text, verdict) for verdict, text in rules]
    return spark.createDataFrame(rows, "host string, path string, rule string, verdict string")


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): all rules for the host itself or a domain above it."""
    labels = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"))
    named = rules.select(F.col("host").alias("domain"), F.struct(F.length("rule").alias("size"), "rule", "path", "verdict").alias("r"))
    return above.join(named, "domain").groupBy("host").agg(F.collect_list("r").alias("rules"))


def _weights(counted: DataFrame) -> DataFrame:
    """(token, weight): how much likelier a token is in allowed than in blocked urls, as a logarithm,
    from (token, allowed, blocked)."""
    totals = counted.agg(F.sum("allowed"), F.sum("blocked"), F.count(F.lit(1))).first()
    allowed, blocked, kinds = (float(t or 0) for t in totals)
    share = lambda n, of: F.log((F.col(n) + _SMOOTHING) / (of + _SMOOTHING * kinds))
    return counted.select("token", (share("allowed", allowed) - share("blocked", blocked)).alias("weight"))


def _scores(parts: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """(key, score): the summed weights of the key's tokens."""
    each = parts.select(key, F.explode("tokens").alias("token"))
    return each.join(weights, "token").groupBy(key).agg(F.sum("weight").alias(f"{key}_score"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``, ``score``) of every url.

    ``rules`` are (``allow`` or ``block``, host and path prefix). A rule fits its host and all subdomains where
    the path starts with the rule's; of those that fit, the longest counts, equally long ones in
    order of their text. Without one ``rule`` is null, and the verdict is ``allow`` if the naive
    Bayes score (log odds of allowed, learnt from the urls that rules decide) is 0 or more, else
    ``block``. A null url, or one without ``://``, has an empty host and path, and is judged by the prior alone.
    One row per input row; repeated rows get equal results; an empty table gives an empty result.
    Without any url that a rule decides all others score 0. The rules are sent to all tasks.
    """
    spark = pages.sparkSession
    named = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    named = checkpointed(named.withColumn("shape", F.regexp_replace(F.translate("path", _ABC.upper(), _ABC), "[0-9]+", "#")))
    hosts = checkpointed(named.select("host").distinct())
    host_rules = checkpointed(_host_rules(hosts, F.broadcast(rules_table(spark, rules))))
    ruled = checkpointed(
        named.join(host_rules, "host", "left")
        .withColumn("fits", F.filter(F.col("rules"), lambda r: F.startswith(F.col("path"), r["path"])))
        .withColumn("best", F.array_max(F.col("fits")))
        .select("id", "host", "path", "shape", "best.rule", "best.verdict")
    )

    decided = ruled.where("rule IS NOT NULL").groupBy("host", "shape").agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )
    decided = checkpointed(decided)
    labels = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("at", "label")).where("label <> ''")
    split = segment_labels(labels.select("label").distinct(), checkpointed(word_counts(pages, html_col)))
    host_parts = checkpointed(
        labels.join(split, "label").groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "tokens"))), lambda x: x["tokens"])).alias("tokens"))
        .withColumn("tokens", F.transform("tokens", lambda t: F.concat(F.lit("host "), t)))
    )
    shapes = ruled.select("shape").distinct()
    pieces = F.filter(F.split("shape", "[^a-z0-9#]+"), lambda t: t != "")
    path_parts = checkpointed(shapes.select("shape", F.transform(pieces, lambda t: F.concat(F.lit("path "), t)).alias("tokens")))

    def tokens_of(parts: DataFrame, key: str) -> DataFrame:
        sums = decided.groupBy(key).agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
        return parts.join(sums, key, "left").select(
            F.explode("tokens").alias("token"), F.coalesce("allowed", F.lit(0)).alias("allowed"), F.coalesce("blocked", F.lit(0)).alias("blocked")
        )

    counted = tokens_of(host_parts, "host").union(tokens_of(path_parts, "shape")).groupBy("token").agg(
        F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
    )
    weights = checkpointed(_weights(checkpointed(counted)))
    urls = decided.agg(F.sum("allowed"), F.sum("blocked")).first()
    learnt = sum(n or 0 for n in urls) > 0
    prior = math.log(((urls[0] or 0) + _SMOOTHING) / ((urls[1] or 0) + _SMOOTHING))
    by_host = checkpointed(_scores(host_parts, "host", weights))
    by_shape = checkpointed(_scores(path_parts, "shape", weights))
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("shape_score", F.lit(0.0))
    judged = ruled.join(by_host, "host", "left").join(by_shape, "shape", "left").withColumn("score", score if learnt else F.lit(0.0))
    verdict = F.coalesce("verdict", F.when(F.col("score") >= 0, "allow").otherwise("block"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
