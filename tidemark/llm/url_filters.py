"""URL rules by expression lookup: host suffixes and path prefixes, joined on short hashes, confirmed on full digests.

Every URL is expanded into the expressions that some rule could have: its host and the parent domains, each with the
beginnings of its path at the lengths that occur in the rules. Expressions meet rules in an equality join on the first
32 bits of their SHA-256; the full digest confirms, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a text without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def short(full: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(full, 1, 8), 16, 10).cast("bigint")


def expressions(urls: DataFrame, labels: int, lengths: list[int]) -> DataFrame:
    """A row for each (host, path) and expression. ``labels``: the most name parts that a rule's host has."""
    parts = F.split("host", r"\.")
    suffixes = F.when(
        F.col("host") != "",
        F.transform(
            F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
            lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
        ),
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.col("path").substr(F.lit(1), n))
    return (
        urls.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", digest(F.concat("suffix", "prefix")).alias("digest"))
        .withColumn("short", short(F.col("digest")))
    )


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """A row for each page: the id, host, path, the winning rule (host and path joined; else null) and the verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the page's path starts with
    the rule's; the longest host and path together win, then the longer host, then ``block``. Without a fitting rule
    the verdict is ``default``. Null URLs and texts without ``://`` have an empty host, which no rule fits; an empty
    path does not start with ``/``. Repeated pages stay repeated, other columns are left out, rules with a null are
    ignored, empty tables give empty results.
    """
    host, path = host_and_path(col(url_col))
    wanted = pages.select(col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    rules = rules.select("host", "path", "verdict").dropna().filter("host <> ''").distinct()
    shape = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()  # two small facts about the rules: numbers of name parts and path lengths
    known = rules.select(
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict",
        digest(F.concat("host", "path")).alias("full"),
    ).withColumn("short", short(F.col("full")))
    seen = wanted.select("host", "path").distinct()
    met = expressions(seen, shape["labels"] or 1, sorted(shape["lengths"]) or [0]).join(known, "short")
    best = F.max(F.struct(F.length("rule"), "host_length", (F.col("verdict") == "block"), "rule", "verdict"))
    found = (
        met.filter(F.col("digest") == F.col("full"))
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return wanted.join(found, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
