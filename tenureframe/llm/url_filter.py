"""URL filters as a sort-merge range join of canonical keys. DataFrame functions only.

A rule is a host, a path prefix and a verdict; it fits the host and all its
subdomains. A host's canonical key is its labels in reverse with a dot after each,
so a rule's host is a prefix of the keys of all hosts it fits: the interval from the key
to the key with the byte FF behind it, which no UTF-8 text has. Likewise a rule's path,
behind its host's key and a byte FE, is an interval of paths under that host.

Such intervals are nested or apart. Interval starts, interval ends and keys are sorted
together, and a sweep keeps a stack of the active rules, with one place per depth: the
count of open intervals is the depth, and the last start at a depth holds its place. A
first sweep, over the distinct hosts, gives each host the whole stack of rule hosts; a
second one, over the distinct paths below them, gives the innermost rule path. Over the
rule hosts the longest rule wins.

The sorted keys are cut into ranges at sampled keys, and an interval goes to every range
that it reaches into, so no host or rule has to lie in one task; ``ranges`` bounds how
often an interval is repeated. Paths are cut to the longest rule path of their rule host
and taken once each, so a host with very many pages weighs no more than its distinct path
beginnings. Pages meet the result by equal host and path; adaptive execution splits hot
ones.

Defined results: a NULL url, or one without ``://``, has an empty host and path;
repeated rows are judged each; no rule: verdict ``default``; of equal rules the
block wins; of equally long rules at different hosts the one with the longer host
wins; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenureframe.operators import range_of, split_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Host, path and verdict of the rules of the query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_START, _POINT, _END = 0, 1, 2
# Into how many ranges the keys of a sweep are cut.
RANGES = 256


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    names = ("rule_host", "rule_path", "verdict")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    if not rows:
        return spark.sql("SELECT '' AS rule_host, '' AS rule_path, '' AS verdict WHERE false")
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, with A to Z in lower case, and path of a url."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    after = F.when(F.instr(text, "://") > 0, F.substr(text, F.instr(text, "://") + 3))
    rest = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def reversed_labels(host: str) -> Column:
    return F.reverse(F.split(F.col(host), r"\.", -1))


def canonical_key(labels: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("."))


def path_key(key: str, path: str) -> Column:
    """Paths sort below the host that they are looked up at."""
    return F.concat(F.col(key).cast("binary"), F.unhex(F.lit("FE")), F.col(path).cast("binary"))


def active_prefixes(
    points: DataFrame, prefixes: DataFrame, innermost: bool = False, ranges: int = RANGES
) -> DataFrame:
    """For each point ``at`` the prefixes of it (``at``, ``prefix``), all or the longest.

    Both are binary columns without the byte FF, in distinct rows. The sweep goes range by
    range, over intervals from each prefix to its end.
    """
    splits = split_rows(points, ["at"], ["at"], ranges)
    behind = F.concat("prefix", F.unhex(F.lit("FF")))

    def placed(at: str) -> Column:
        return range_of("splits", [F.col(at).alias("at")], True, ranges)

    reached = (
        prefixes.withColumn("behind", behind)
        .withColumn("splits", splits)
        .withColumn("range", F.explode(F.sequence(placed("prefix"), placed("behind"))))
    )
    nothing = F.lit(None).cast("binary")
    events = (
        reached.select("range", F.col("prefix").alias("at"), F.lit(_START).alias("kind"), "prefix")
        .unionByName(
            reached.select(
                "range", F.col("behind").alias("at"), F.lit(_END).alias("kind"), nothing.alias("prefix")
            )
        )
        .unionByName(
            points.withColumn("splits", splits).select(
                placed("at").alias("range"),
                "at",
                F.lit(_POINT).alias("kind"),
                nothing.alias("prefix"),
            )
        )
    )
    change = F.when(F.col("kind") == _START, 1).when(F.col("kind") == _END, -1).otherwise(0)
    sweep = Window.partitionBy("range").orderBy("at", "kind")
    opened = events.withColumn("depth", F.sum(change).over(sweep)).filter(
        (F.col("kind") != _END) & (F.col("depth") > 0)
    )
    # A point asks every place of the stack below its depth, or the last one only.
    asks = F.when(F.col("kind") == _POINT, F.sequence(F.lit(1).cast("bigint"), "depth"))
    own = F.array("depth")
    places = own if innermost else F.coalesce(asks, own)
    stack = Window.partitionBy("range", "place").orderBy("at", "kind")
    return (
        opened.withColumn("place", F.explode(places))
        .withColumn("active", F.last("prefix", ignorenulls=True).over(stack))
        .filter(F.col("kind") == _POINT)
        .select("at", F.col("active").alias("prefix"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: its id, ``host``, ``path``, ``rule`` and ``verdict``."""
    # "block" is the greater of the two verdicts.
    rules = (
        rules.groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", canonical_key(reversed_labels("rule_host")))
    )
    rule_hosts = rules.groupBy("key").agg(F.max(F.length("rule_path")).alias("longest"))

    host, path = host_and_path(url_col)
    urls = pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"))
    hosts = urls.select("host").distinct()
    hosts = hosts.withColumn("at", canonical_key(reversed_labels("host")).cast("binary"))
    host_rules = (
        active_prefixes(
            hosts.select("at").distinct(), rule_hosts.select(F.col("key").cast("binary").alias("prefix"))
        )
        .select("at", F.col("prefix").cast("string").alias("key"))
        .join(hosts, "at")
        .select("host", "key")
        .join(rule_hosts, "key")
    )
    seen = (
        urls.select("host", "path")
        .distinct()
        .join(host_rules, "host")
        .withColumn("begin", F.substr("path", F.lit(1), F.col("longest")))
        .withColumn("at", path_key("key", "begin"))
    )
    rules = rules.withColumn("prefix", path_key("key", "rule_path"))
    found = active_prefixes(
        seen.select("at").distinct(), rules.select("prefix"), innermost=True
    ).join(rules, "prefix")
    length = F.length("rule_host") + F.length("rule_path")
    best = (
        seen.select("host", "path", "at")
        .join(found, "at")
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"),
                F.struct(length, F.length("rule_host"), "rule_host"),
            ).alias("best")
        )
    )
    return urls.join(best, ["host", "path"], "left").select(
        F.col("page").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
