"""URL filters: rules per host and path, and link-graph propagation for the rest.

Trust starts at hosts whose pages the allow rules fit and follows links
(personalised PageRank); distrust starts at hosts whose pages the block rules
fit and follows links backwards.  Both start from the fitting share of a host's
pages; a host that is linked to but has no pages starts from the rule for all its
paths, if there is one.  A host hands trust on in equal parts, and takes distrust over
in equal parts of its links: how much it gets says how many of its own links lead to
blocked hosts, however many other hosts link there too.  Ranks are whole numbers of
``UNIT``-ths, so sums don't depend on their order and every run gives the same verdicts.

Inputs: a null url, or one without ``://``, has empty host and path, fits no
rule and is allowed.  Null html has no links; links that begin with ``//`` count like
those with a scheme.  Repeated pages count as pages.  Repeated links between two hosts count
once; links within a host don't count.  Very long pages are read whole.  Of fitting rules of
equal length the greater one (by text) wins.  An empty table gives an empty one; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_LOWER, TEXT_UPPER, stage

UNIT = 10**12
DAMPING = 85  # percent of a host's rank that its links carry on
ROUNDS = 12
# A host is blocked when distrust exceeds trust by half of what a host keeps
# whose pages are all blocked by rules: about when three in five of its links lead to such.
THRESHOLD = UNIT * (100 - DAMPING) // 200
LINK = r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    # Lower-cased after the cut, so that only A-Z of the host change.
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), TEXT_UPPER, TEXT_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def parse_rules(spark, block: list[str], allow: list[str]) -> DataFrame:
    """``rule_host, rule_path, rule, ruling`` of rules like ``example.net/en/``."""
    rows = []
    for ruling, rules in (("block", block), ("allow", allow)):
        for r in rules:
            host, slash, path = r.partition("/")
            rows.append((host, slash + path, r, ruling))
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule string, ruling string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``: those of its own and its parent domains' rules, longest first."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    fits = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    one = F.struct(F.length("rule").alias("size"), "rule", "rule_path", "ruling")
    return fits.groupBy("host").agg(F.sort_array(F.collect_set(one), asc=False).alias("rules"))


def edges(pages: DataFrame) -> DataFrame:
    """Distinct ``src, dst`` between hosts, by the absolute links of ``pages``."""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
    link = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    pairs = links.select(F.col("host").alias("src"), host_of(link).alias("dst"))
    return pairs.where("src <> dst AND src <> '' AND dst <> ''").distinct()


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """``kind, host, rank``: ``seeds`` (``kind, host, seed`` in UNITs) spread over
    ``links`` (``kind, src, dst``) by personalised PageRank, one per kind.

    A host hands ``damping`` percent of its rank to its links in equal parts, or to each
    the part that its ``fanout`` says; one without links hands nothing on.  Every few rounds
    the ranks are staged, which keeps the plan short and survives lost executors."""
    if "fanout" not in links.columns:
        links = links.join(links.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("fanout")), ["kind", "src"])
    graph = stage(links, "host-links")
    base = seeds.select("kind", "host", ((100 - damping) * F.col("seed") / 100).cast("long").alias("own"))
    ranks = base.withColumnRenamed("own", "rank")
    if graph.isEmpty():
        return ranks
    base = stage(base, "host-seeds")
    for i in range(rounds):
        given = graph.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), F.expr(f"(rank * {damping}) div (100 * fanout)").alias("rank")
        )
        ranks = base.withColumnRenamed("own", "rank").unionByName(given).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % 3 == 2:
            ranks = stage(ranks, "host-ranks")
    return ranks


def judge_pages(
    pages: DataFrame,
    block: list[str],
    allow: list[str],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict`` and the host's
    ``trust`` and ``distrust`` (0 to 1)."""
    spark = pages.sparkSession
    url = F.col(url_col)
    base = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).alias("html"))
    plain = base.drop("html")
    hosts = plain.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where("host <> ''")
    rules = parse_rules(spark, block, allow)
    fits = stage(host_rules(hosts, rules), "host-rules")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    ruled = plain.join(fits, "host", "left").withColumn("best", F.get(fitting, F.lit(0)))
    ruled = ruled.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.ruling").alias("ruling"))

    counted = stage(
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("ruling") == "allow").alias("allowed"),
            F.count_if(F.col("ruling") == "block").alias("blocked"),
        ),
        "host-counts",
    )
    links = stage(edges(base), "host-edges")
    # Hosts without pages: what the rule for all their paths says.
    unseen = links.select(F.col("dst").alias("host")).distinct().join(counted.select("host"), "host", "left_anti")
    told = host_rules(unseen, rules.where("rule_path = '/'")).select("host", F.get("rules", F.lit(0))["ruling"].alias("ruling"))
    told = told.select("host", F.lit(1).cast("bigint").alias("pages"), *[(F.col("ruling") == v).cast("bigint").alias(c) for v, c in (("allow", "allowed"), ("block", "blocked"))])
    seeds = counted.unionByName(told).select(
        "host",
        F.inline(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.expr(f"(allowed * {UNIT}) div pages").alias("seed")),
                F.struct(F.lit("distrust").alias("kind"), F.expr(f"(blocked * {UNIT}) div pages").alias("seed")),
            )
        ),
    ).where("seed > 0")
    there = links.join(links.groupBy("src").agg(F.count(F.lit(1)).alias("fanout")), "src")
    both = there.select(F.lit("trust").alias("kind"), "src", "dst", "fanout").unionByName(
        there.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "fanout")
    )
    ranks = propagate(seeds, both)
    verdicts = counted.select("host").join(
        ranks.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0)).alias("t"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0)).alias("d"),
        ),
        "host",
    )
    method = F.when(F.coalesce(F.col("d") - F.col("t"), F.lit(0)) > threshold, "block").otherwise("allow")
    return ruled.join(verdicts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruling", method).alias("verdict"),
        (F.coalesce("t", F.lit(0)) / UNIT).alias("trust"),
        (F.coalesce("d", F.lit(0)) / UNIT).alias("distrust"),
    )
