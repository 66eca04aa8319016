"""URL filters: rules by host and path, and for the rest a verdict a host from the link graph.

Hosts are the nodes, links from the pages of one host to another the edges. Trust starts at hosts with
URLs that a rule allows and follows the links: personalised PageRank, in which a host hands on a part of
its score to the hosts it links to, in equal shares. Distrust starts at hosts with URLs that a rule blocks
and follows the links backwards, to the hosts that link there. A host is blocked if its distrust reaches
a threshold and exceeds its trust.

Scores are whole millionths, shares are rounded down and only sums are formed, so a result depends on
neither the order of rows nor the number of tasks. Scores only grow from one round to the next; rounds end
when none did, or at a limit. Every round is a table in the shared folder.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.staging import Staging

RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Rules are tried one after the other in one expression, so there can't be many.
MOST_RULES = 200
UNIT = 1_000_000
# Per cent of a score that is handed on.
HANDED_ON = 85
ROUNDS = 40
# A host half of whose known URLs are blocked by rules, without links, just reaches it.
THRESHOLD = UNIT * (100 - HANDED_ON) // 200
# Links of one host, in one direction, that meet in one key of the join. A host with more has slices.
SLICE_LINKS = 10_000
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>]+)"""


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased.

    Empty without ``://`` and for a null.
    """
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where ``host_of`` finds no host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, both null if none does.

    A rule is a verdict and a host with the start of a path, like ``example.com/de/``. It fits its host
    and all subdomains where the path starts with the rule's. Of equally long ones the first is taken.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; one expression tries at most {MOST_RULES}")
    found = F.lit(None).cast("struct<rule string, verdict string>")
    # The last condition added is tried first.
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url_col: str = "url"
) -> DataFrame:
    """``pages`` with a struct ``place`` of ``host``, ``path``, ``rule`` and the rule's ``verdict``."""
    url = F.col(url_col)
    return (
        pages.withColumn("place", F.struct(host_of(url).alias("host"), path_of(url).alias("path")))
        .withColumn("_ruled", rule_of(F.col("place.host"), F.col("place.path"), rules))
        .withColumn("place", F.struct("place.*", "_ruled.*"))
        .drop("_ruled")
    )


def outlinks(html: Column) -> Column:
    """The different absolute URLs that anchors of a page link to; ``//host`` counts as ``http``."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1))

    def whole(url: Column) -> Column:
        return F.when(url.startswith("//"), F.concat(F.lit("http:"), url)).otherwise(url)

    return F.array_distinct(F.transform(found, whole))


def _seeds(known: DataFrame) -> DataFrame:
    """What hosts start with: (kind, host, base), from the share of their known URLs that rules judge.

    ``known`` has ``host``, ``verdict`` and ``n``, summed already as far as its source could.
    """
    own = UNIT * (100 - HANDED_ON)
    counts = known.groupBy("host").agg(
        F.sum("n").alias("all"),
        *[
            F.sum(F.when(F.col("verdict") == verdict, F.col("n")).otherwise(0)).alias(verdict)
            for verdict in ("allow", "block")
        ],
    )
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(verdict).alias("n"))
            for kind, verdict in (("trust", "allow"), ("distrust", "block"))
        ]
    )
    base = F.call_function("div", F.col("n") * own, F.col("all") * 100)
    return (
        counts.select("host", "all", F.inline(kinds))
        .where("n > 0")
        .select("kind", "host", base.alias("base"))
        .where("base > 0")
    )


def _routes(edges: DataFrame, staging: Staging, slice_links: int) -> DataFrame:
    """Where scores of each kind flow: (kind, host, slice, to, degree, slices).

    ``edges`` are different pairs (source, target) of different hosts.
    """
    ways = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to")),
        F.struct(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to")),
    )
    flows = edges.select(F.inline(ways))
    degrees = staging.table(
        flows.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree")), "degrees"
    )
    slices = F.ceil(F.col("degree") / F.lit(slice_links)).cast("int")
    # Both sides come straight from a shuffle, so adaptive execution may split a large host here; the
    # rounds, which meet the same hosts again and again, have the slices.
    return flows.join(degrees, ["kind", "host"]).select(
        "kind",
        "host",
        F.pmod(F.xxhash64("to"), slices).cast("int").alias("slice"),
        "to",
        "degree",
        slices.alias("slices"),
    )


def host_scores(
    known: DataFrame,
    edges: DataFrame,
    staging: Staging,
    rounds: int = ROUNDS,
    slice_links: int = SLICE_LINKS,
) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` in millionths of all hosts where one of them is not zero.

    ``known`` are URLs as (host, verdict, n), ``edges`` different pairs (source, target) of hosts. A score
    is 15 % of the share of the host's URLs that rules allow (block) and 85 % of what comes over links; a
    host without links in the direction of the score hands on nothing. After ``rounds`` rounds what is
    still missing from a score is under 0.85 to that power of all scores.
    """
    base = staging.table(_seeds(known), "seeds")
    routes = staging.table(_routes(edges, staging, slice_links), "routes")
    sliced = staging.table(
        routes.groupBy("kind", "host").agg(F.max("slices").alias("slices")), "slices"
    )
    total = F.coalesce(F.sum("score"), F.lit(0)).alias("total")
    scores, before = staging.measured(
        base.withColumnRenamed("base", "score"), "scores", total
    )
    share = F.call_function("div", F.col("score") * HANDED_ON, F.col("degree") * 100)
    for _ in range(rounds):
        sent = scores.join(sliced, ["kind", "host"]).withColumn(
            "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
        )
        received = sent.select("kind", "host", "slice", "score").join(
            routes.drop("slices"), ["kind", "host", "slice"]
        ).select("kind", F.col("to").alias("host"), share.alias("score"))
        scores, after = staging.measured(
            base.withColumnRenamed("base", "score")
            .unionByName(received)
            .groupBy("kind", "host")
            .agg(F.sum("score").alias("score")),
            "scores",
            total,
        )
        # No score ever falls, so an equal total is an equal table.
        if after == before:
            break
        before = after
    kinds = [
        F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0)).alias(kind)
        for kind in ("trust", "distrust")
    ]
    return scores.groupBy("host").agg(*kinds)


def verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: int = THRESHOLD,
    rounds: int = ROUNDS,
    slice_links: int = SLICE_LINKS,
    staging: Staging | None = None,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``, a row a page.

    Where a rule fits, its verdict holds. Elsewhere a page is blocked if its host's distrust is at least
    ``threshold`` and more than its trust, and allowed otherwise; pages without a host are allowed.
    ``trust`` and ``distrust`` are the host's scores in millionths, 0 where it has none.

    Known URLs of a host are those of its pages and the targets of links, each target once a page. Links
    within a host and those of null or empty pages make no edges. Null ids stay null, repeated rows stay
    repeated and count as often; other columns are not looked at. An empty table gives an empty result.
    """
    staging = staging or Staging(pages.sparkSession)
    plain = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    targets = F.transform(
        outlinks(F.col("html")),
        lambda url: F.struct(host_of(url).alias("host"), path_of(url).alias("path")),
    )
    # One reading of the pages; what is kept of them has no texts.
    read = staging.table(
        judged(plain, rules).select("page_id", "place.*", targets.alias("targets")), "pages"
    )
    links = read.select("host", F.explode("targets").alias("to")).select(
        F.col("host").alias("source"),
        F.col("to.host").alias("target"),
        rule_of(F.col("to.host"), F.col("to.path"), rules)["verdict"].alias("verdict"),
    )
    counted = F.count(F.lit(1)).alias("n")
    known = (
        read.select("host", "verdict")
        .unionByName(links.select(F.col("target").alias("host"), "verdict"))
        .where("host <> ''")
        .groupBy("host", "verdict")
        .agg(counted)
    )
    edges = (
        links.where("source <> '' and target <> '' and source <> target")
        .select("source", "target")
        .distinct()
    )
    scores = host_scores(known, edges, staging, rounds, slice_links)
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return (
        read.drop("targets")
        .join(scores, "host", "left")
        .fillna(0, ["trust", "distrust"])
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
            "trust",
            "distrust",
        )
    )
