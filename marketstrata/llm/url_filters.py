"""URL rules looked up by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; NULL or no ``://``: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _slash_prefix(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _short(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def match_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``action``. A rule fits its host and all subdomains if the path starts
    with the rule's. The longest host wins, then the longest path, then ``block`` before other actions, so
    repeated or conflicting rules have one defined outcome. No fitting rule: ``rule`` NULL, verdict ``default``.

    A URL becomes expressions (host suffix, path up to a slash), as many as the deepest rule needs, so very long
    hosts and paths do not multiply. They meet the rules by a 32-bit hash prefix in an equi-join, which Spark
    broadcasts only when the rules are measurably small and splits when a key is hot; the whole digest and the
    path then confirm. NULL, empty and malformed URLs have empty host and path. Other columns are kept, except
    that the four result names are replaced. Repeated rows stay repeated. No urls give no rows; no rules give every
    url the default.
    """
    rules = (
        rules.filter("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL")
        .select(
            F.translate("host", _UPPER, _LOWER).alias("rule_host"),
            F.col("path").alias("rule_path"),
            F.col("action").alias("rule_action"),
        )
        .withColumn("rule_digest", F.sha2(F.concat("rule_host", F.lit("\n"), _slash_prefix(F.col("rule_path"))), 256))
        .withColumn("rule_short", _short(F.col("rule_digest")))
    )
    labels, depth = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))), F.max(F.size(F.split("rule_path", "/")))
    ).first()
    labels, depth = labels or 1, depth or 1
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    rows = urls.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*kept).alias("_kept"),
        url_host(F.col(url)).alias("_host"),
        url_path(F.col(url)).alias("_path"),
    )
    suffixes = F.array(*[F.substring_index("_host", ".", -n) for n in range(1, labels + 1)])
    whole = _slash_prefix(F.col("_path"))
    prefixes = F.array(
        F.lit(""),
        *[
            F.when(F.size(F.split("_path", "/")) > n, F.concat(F.substring_index("_path", "/", n), F.lit("/"))).otherwise(whole)
            for n in range(1, depth + 1)
        ],
    )
    expressions = F.array_distinct(
        F.flatten(
            F.transform(
                F.array_distinct(suffixes),
                lambda h: F.transform(
                    F.array_distinct(prefixes),
                    lambda p: F.sha2(F.concat(h, F.lit("\n"), p), 256),
                ),
            )
        )
    )
    keyed = rows.select("*", F.explode(expressions).alias("_digest")).withColumn("_short", _short(F.col("_digest")))
    met = keyed.join(
        rules,
        (F.col("_short") == F.col("rule_short"))
        & (F.col("_digest") == F.col("rule_digest"))
        & F.col("_path").startswith(F.col("rule_path")),
        "left",
    )
    best = F.max(
        F.when(
            F.col("rule_host").isNotNull(),
            F.struct(
                F.length("rule_host").alias("h"),
                F.length("rule_path").alias("p"),
                (F.col("rule_action") == "block").alias("b"),
                F.concat("rule_host", "rule_path").alias("rule"),
                F.col("rule_action").alias("action"),
            ),
        )
    )
    chosen = met.groupBy("_row").agg(
        F.first("_kept").alias("_kept"), F.first("_host").alias("host"), F.first("_path").alias("path"), best.alias("_best")
    )
    return chosen.select(
        "_kept.*", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict")
    )
