"""From session text to classified lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip_control
from tidemark.functions.times import parse_time

# Fixed line patterns of the log format, in the order in which they are tried.
LINE_PATTERNS = {
    "SESSION_START": r"^SESSION_START\s+(\S+)\s*$",
    "SESSION_END": r"^SESSION_END\s+(\S+)\s*$",
    "QS": r"^QS\s+(\S+)\s+\{(.*)\}\s*$",
    "CARD_START": r"^CARD_SEARCH_START\s+(\S+)\s*$",
    "CARD_END": r"^CARD_SEARCH_END$",
    "OPEN": r"^DOC_OPEN\s+(\S+)\s+(\S+)\s+(\S+)\s*$",
    "OPEN_UNTIMED": r"^DOC_OPEN\s+(\S+)\s+(\S+)\s*$",
    "PARAM": r"^\$(\S+)\s+(.+)$",
    "RESULTS": r"^(-?\d+)((?:\s+\S+)*)\s*$",
}
TIMED = ("SESSION_START", "SESSION_END", "QS", "CARD_START", "OPEN")
BAD_TIME = "BAD_TIME"
UNKNOWN = "UNKNOWN"


def to_lines(chunks: DataFrame) -> DataFrame:
    """Split ``content`` into trimmed, non-blank lines with a line number that keeps the file order.

    A session may arrive in several chunks; then ``line_base`` gives the number of each chunk's first line.
    """
    base = F.col("line_base") if "line_base" in chunks.columns else F.lit(0).cast("bigint")
    pieces = chunks.select("session_id", base.alias("base"), F.posexplode(F.split("content", "[\n\f]")))
    return pieces.select(
        "session_id", (F.col("base") + F.col("pos")).alias("line_no"), strip_control(F.col("col")).alias("line")
    ).filter(F.col("line") != "")


def line_kind(line: Column) -> Column:
    """Name of the first pattern the line matches; the cheap prefix test spares most regex calls."""
    prefixes = {
        "SESSION_START": "SESSION_START", "SESSION_END": "SESSION_END", "QS": "QS",
        "CARD_START": "CARD_SEARCH_START", "CARD_END": "CARD_SEARCH_END",
        "OPEN": "DOC_OPEN", "OPEN_UNTIMED": "DOC_OPEN", "PARAM": "$",
    }
    tries = []
    for kind, pattern in LINE_PATTERNS.items():
        hit = line.rlike(pattern)
        if kind in prefixes:
            hit = line.startswith(prefixes[kind]) & hit
        tries.append(F.when(hit, F.lit(kind)))
    return F.coalesce(*tries, F.lit(UNKNOWN))


def classify(lines: DataFrame) -> DataFrame:
    """Add the line kind and its fields. A timed line whose time cannot be read becomes BAD_TIME."""
    kind = F.col("shape")

    def only(kinds: tuple[str, ...], value: Column) -> Column:
        return F.when(kind.isin(*kinds), value)

    word = F.col("words")
    shaped = lines.withColumn("shape", line_kind(F.col("line")))
    split = shaped.withColumn(
        "words",
        F.when(kind.isin(*TIMED, "OPEN_UNTIMED", "PARAM", "RESULTS"), F.split("line", r"\s+")),
    )
    # Inlined, the two time forms make the code of this step a method so long that the JVM never compiles any of it.
    times = F.transform(F.array("token"), parse_time)
    timed = split.withColumn("token", only(TIMED, word[1])).withColumn("time", times[0])
    bad = kind.isin(*TIMED) & F.col("time").isNull()
    # The one-row generator keeps filters on these fields above it; pushed below, a filter would repeat every regex.
    fields = F.struct(
        F.when(bad, BAD_TIME).otherwise(kind).alias("kind"),
        "time",
        F.when(~bad, F.regexp_extract(F.when(kind == "QS", F.col("line")), LINE_PATTERNS["QS"], 2)).alias("query"),
        F.when(kind == "OPEN", word[2])
        .when(kind == "OPEN_UNTIMED", word[1])
        .when(kind == "RESULTS", word[0])
        .alias("search_id"),
        F.when(kind == "OPEN", word[3]).when(kind == "OPEN_UNTIMED", word[2]).alias("doc_id"),
        F.when(kind == "RESULTS", F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0)))).alias("docs"),
        F.when(
            kind == "PARAM",
            F.struct(
                F.expr("substring(words[0], 2)").alias("param_id"),
                strip_control(F.regexp_extract("line", LINE_PATTERNS["PARAM"], 2)).alias("value"),
            ),
        ).alias("param"),
        F.when(bad, F.concat(F.lit("unparseable timestamp: "), word[1]))
        .when(kind == UNKNOWN, F.lit("unrecognized prefix"))
        .alias("error"),
        "line",
    )
    return timed.select("session_id", "line_no", F.inline(F.array(fields)))
