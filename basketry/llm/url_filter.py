"""URL filter: rules first, then trust and distrust spread over the host graph.

Rules (allow or block; a host with its subdomains and a path prefix) decide the
urls they fit, the longest rule first. They seed two personalised PageRanks over
host edges: trust starts at every host by its number of allowed pages and follows
links; distrust starts at every host by its number of blocked pages and goes
against the links (who links to a bad host is suspect). The share of distrust in
what reaches a host decides its remaining urls.

Edges are the links of a page's html to other hosts, plus an edge from each domain
name to the one above it and back, from the host up to two labels, weighted by
the pages below: a host without outgoing links still hears from its domain, also
where the domains in between have no pages. Edges are summed per pair of hosts
before any shuffle; a page never crosses the network, a host with a third of all
pages is one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ascii_lower, materialise, small

# fixed values: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: a ranking is done when so many rounds add at most this share to any host's score
ROUNDS_PER_CHECK, TOLERANCE = 8, 1e-4
#: a host is blocked if distrust holds at least this share of distrust + trust,
#: to so many digits (the ranking leaves out less than these show)
BLOCK_SHARE, DIGITS = 0.5, 3
#: edges of the host graph that a task takes in a round
EDGES_PER_TASK = 500_000
#: longer hosts are no domain names and have no names above them (fixed value of DNS)
MAX_NAME = 253
_LINK = r"""(?i)\shref\s*=\s*["']?([a-z][a-z0-9+.-]*://[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[\s\S]*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without a host part."""
    rest = F.coalesce(url, F.lit(""))
    return F.regexp_extract(rest, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)


def _fits(host: Column, rule_host: str) -> Column:
    return (host == rule_host) | host.endswith("." + rule_host)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits.

    One expression over the row: the rules are a parameter of some hundred
    entries at most; of fitting rules equally long the one named last wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = _fits(host, h) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_graph(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, allow, block`` (pages per host and rule verdict) and ``src, dst, weight``."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    _, verdict = rule_of(F.col("host"), F.col("path"))
    seen = pages.select(host.alias("host"), path.alias("path"), "html").withColumn("verdict", verdict)
    hosts = materialise(
        seen.where("host <> ''").groupBy("host").agg(
            F.count_if(F.col("verdict") == "allow").alias("allow"),
            F.count_if(F.col("verdict") == "block").alias("block"),
            F.count(F.lit(1)).alias("pages"),
        )
    )
    links = seen.where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), 1))).alias("link")
    )
    links = links.select("src", host_of(F.col("link")).alias("dst")).where("dst <> '' and dst <> src")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    # a name and the one above it, both ways, up to two labels
    labels = F.when(F.octet_length("host") <= MAX_NAME, F.split("host", r"\.")).otherwise(F.array())
    names = F.transform(F.col("labels"), lambda _, i: F.array_join(F.slice("labels", i + 1, F.size("labels")), "."))
    steps = F.arrays_zip(F.slice("names", 1, F.size("names") - 2).alias("src"), F.slice("names", 2, F.size("names") - 2).alias("dst"))
    up = hosts.select("pages", labels.alias("labels")).where(F.size("labels") > 2).select("pages", names.alias("names"))
    up = up.select(F.inline(steps), F.col("pages").cast("double").alias("weight"))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    edges = links.unionByName(up).unionByName(down).where("src <> '' and dst <> ''")
    return hosts, materialise(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def personalised_ranks(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``kind, host, score``: a PageRank per ``kind`` that restarts at its seeds.

    ``edges``: ``kind, src, dst, weight``; ``seeds``: ``kind, host, weight``. The
    scores of a kind sum to at most 1. A round is one join and one sum; scores
    only grow, and what a round adds shrinks by the damping factor. Done when
    ``ROUNDS_PER_CHECK`` rounds, after which the scores are written to the shared
    folder, add at most ``tolerance`` of any host's score: the bound is relative,
    so it holds for graphs of any size. A kind without seeds has no rows. A round
    runs in tasks of ``EDGES_PER_TASK`` edges, so that the many rounds of a small
    graph do not write many empty shuffle files.
    """
    tasks = 1 + edges.count() // EDGES_PER_TASK
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = (F.sum("weight") / F.first("total") * (1 - damping)).alias("score")
    # one row per kind
    start = materialise(seeds.join(F.broadcast(total), "kind").groupBy("kind", "host").agg(start).coalesce(tasks))
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    moves = edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out") * damping).alias("share"))
    moves, score, added = materialise(moves.coalesce(tasks)), start, 1.0
    while added > tolerance:
        before = score.withColumnRenamed("score", "before")
        for _ in range(ROUNDS_PER_CHECK):
            sent = moves.join(score, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("share") * F.col("score")).alias("score"))
            score = sent.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score")).coalesce(tasks)
        score = materialise(score)
        change = F.try_divide(F.col("score") - F.coalesce("before", F.lit(0.0)), "score")
        added = score.join(before, ["kind", "host"], "left").agg(F.max(change)).first()[0] or 0.0
    return score


def host_verdicts(pages: DataFrame, block_share: float = BLOCK_SHARE) -> DataFrame:
    """``host, trust, distrust, verdict`` for every host that has a page."""
    hosts, edges = host_graph(pages)
    kind = lambda name: F.lit(name).alias("kind")
    weight = lambda name: F.col(name).cast("double").alias("weight")
    seeds = hosts.where("allow > 0").select(kind("trust"), "host", weight("allow"))
    seeds = seeds.unionByName(hosts.where("block > 0").select(kind("distrust"), "host", weight("block")))
    along = edges.select(kind("trust"), "src", "dst", "weight")
    against = edges.select(kind("distrust"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ranks = personalised_ranks(along.unionByName(against), seeds)
    score = lambda name: F.coalesce(F.sum(F.when(F.col("kind") == name, F.col("score"))), F.lit(0.0)).alias(name)
    both = hosts.select("host").join(ranks, "host", "left").groupBy("host").agg(score("trust"), score("distrust"))
    share = F.round(F.try_divide(F.col("distrust"), F.col("distrust") + F.col("trust")), DIGITS)
    return both.withColumn("verdict", F.when(share >= block_share, "block").otherwise("allow"))


def url_filter(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A null url, or one without ``://``, has empty host and path, fits no rule and
    is allowed, as is a host that neither trust nor distrust reaches. A null html
    has no links. Repeated rows are pages of their own; an empty table gives an
    empty result; other columns are not read. A host of more than ``MAX_NAME``
    bytes has no names above it; urls and htmls of any length are read whole.
    """
    hosts = materialise(host_verdicts(pages).select(F.col("host").alias("h"), F.col("verdict").alias("method")))
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    rows = rows.join(small(hosts), rows["host"] == hosts["h"], "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "method", F.lit("allow")).alias("verdict"))
