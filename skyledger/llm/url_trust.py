"""URL filter: rules first, then trust and distrust that spread over the links between hosts.

``RULES`` are (verdict, host, path); a rule fits its host and all subdomains if the path starts with the
rule's, and the longest fitting one decides. For all other urls the host decides: trust starts from hosts
in proportion to their share of pages that a rule allows and follows links (personalised PageRank); distrust
starts in proportion to the share of pages that a rule blocks and runs against the links, to hosts that link
there. Each is a damped
power iteration of joins and sums over one table of host edges, run until it is settled. A host whose distrust is at least
``THRESHOLD`` of its trust and distrust together is blocked; a host that neither reaches is allowed.

Host edges are the absolute links of a page to another host, and an edge both ways between a host and
its parent domain, up to the domain of two labels. A domain is a node also where it has no page, so hosts
of one site meet there; a domain of one label is none. Edges are counted before they are shuffled.

Edge cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is allowed; it
has no edges. NULL and empty pages have no links. Repeated pages count for their host and links each.
Without seeds nothing is blocked by the method. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.store import staged

# Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Trust and distrust are settled when a round moves less than this share of either.
TOLERANCE = 1e-6
ROUNDS_PER_LOOK = 6
DAMPING = 0.85
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host(url: Column) -> Column:
    at = F.locate("://", url)
    named = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*", 0)
    return F.when(at > 0, F.translate(named, UPPER, LOWER)).otherwise("")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits; NULL if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        rule, verdict = F.when(fits, of + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """source, target, n between different hosts."""
    links = pages.select(
        host(F.col("url")).alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("to")
    )
    links = links.select("source", F.translate("to", UPPER, LOWER).alias("target"))
    links = links.filter("source <> '' and source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))
    # Each host with every domain above it, the nearest first; one pair of neighbours per step.
    labels = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = F.when(F.size(labels) > 2, chain)
    steps = hosts.filter("host <> ''").select(chain.alias("chain"))
    steps = steps.select(F.inline(F.arrays_zip(
        F.slice("chain", F.lit(1), F.size("chain") - 1).alias("child"), F.slice("chain", F.lit(2), F.size("chain") - 1).alias("parent")
    ))).toDF("child", "parent").filter("child <> '' and parent <> '' and child <> parent").distinct()
    one = F.lit(1).cast("long").alias("n")
    site = steps.select(F.col("child").alias("source"), F.col("parent").alias("target"), one).union(
        steps.select(F.col("parent").alias("source"), F.col("child").alias("target"), one)
    )
    return links.union(site).groupBy("source", "target").agg(F.sum("n").alias("n"))


def flows(edges: DataFrame) -> DataFrame:
    """Both directions as shares: giver, taker, share of the giver's trust, share of its distrust."""
    out = edges.groupBy(F.col("source").alias("giver")).agg(F.sum("n").alias("total"))
    back = edges.groupBy(F.col("target").alias("giver")).agg(F.sum("n").alias("total"))
    along = edges.withColumnsRenamed({"source": "giver", "target": "taker"}).join(out, "giver")
    against = edges.withColumnsRenamed({"target": "giver", "source": "taker"}).join(back, "giver")
    share = F.col("n") / F.col("total")
    return along.select("giver", "taker", share.alias("trust_share"), F.lit(0.0).alias("distrust_share")).union(
        against.select("giver", "taker", F.lit(0.0).alias("trust_share"), share.alias("distrust_share"))
    )


def spread(hosts: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust when settled; ``hosts`` has trust_seed and distrust_seed of sum one (or 0), and
    every end of an edge.

    A round moves at most ``DAMPING`` of what the round before moved, so the rounds are bounded by the
    tolerance and not by the size or the depth of the graph; what is still to come then is below
    DAMPING / (1 - DAMPING) times the tolerance, over all hosts together. Each round is one join and one sum,
    written before the next: the driver holds the plan of one round, however many there are.
    """
    shares = staged(flows(edges), "flows")
    nodes = staged(hosts.select("host", "trust_seed", "distrust_seed"), "seeds")
    state = nodes.select("host", F.col("trust_seed").alias("trust"), F.col("distrust_seed").alias("distrust"))
    kinds, none = ("trust", "distrust"), F.lit(0.0)
    seeded = nodes.select("host", *((1 - DAMPING) * F.col(f"{c}_seed") for c in kinds), none, none)
    for k in count(1):
        given = shares.join(state, F.col("giver") == F.col("host")).select(
            "taker", *(DAMPING * F.col(c) * F.col(f"{c}_share") for c in kinds), none, none
        )
        was = state.select("host", none, none, *kinds)
        columns = ("host", *kinds, *(f"{c}_was" for c in kinds))
        sums = seeded.union(given).union(was).toDF(*columns).groupBy("host").agg(*(F.sum(c).alias(c) for c in columns[1:]))
        state = staged(sums, "spread")
        if k % ROUNDS_PER_LOOK == 0:
            moved = state.agg(*(F.sum(F.abs(F.col(c) - F.col(f"{c}_was"))) for c in kinds)).first()
            if max(m or 0.0 for m in moved) <= tolerance:
                return state.select("host", *kinds)


def host_trust(pages: DataFrame, ruled: DataFrame) -> DataFrame:
    """host, trust, distrust of every host of a page or link; ``ruled`` has host and the rules' verdict."""
    counts = ruled.groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"),
    )
    counts = staged(counts.filter("host <> ''"), "hosts")
    edges = staged(host_edges(pages, counts), "edges")
    targets = edges.select(F.col("target").alias("host")).join(counts, "host", "left_anti").distinct()
    seeded = counts.select(
        "host", (F.col("allowed") / F.col("pages")).alias("trust_seed"),
        (F.col("blocked") / F.col("pages")).alias("distrust_seed"),
    ).union(targets.select("host", F.lit(0.0), F.lit(0.0)))
    totals = seeded.agg(F.sum("trust_seed"), F.sum("distrust_seed")).first()
    trusted, distrusted = (t or 1.0 for t in totals)
    seeded = seeded.select(
        "host", (F.col("trust_seed") / trusted).alias("trust_seed"),
        (F.col("distrust_seed") / distrusted).alias("distrust_seed"),
    )
    return spread(seeded, edges)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust where no rule fits."""
    own = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    own = own.withColumn("host", F.coalesce("host", F.lit("")))
    rule, by_rule = fitting(F.col("host"), F.col("path"), rules)
    ruled = own.withColumns({"rule": rule, "by_rule": by_rule})
    trust = host_trust(pages, ruled).withColumnRenamed("host", "of")
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    by_method = F.when((F.col("distrust") > 0) & (share >= THRESHOLD), "block").otherwise("allow")
    open_ = F.col("rule").isNull() & (F.col("host") == F.col("of"))
    return ruled.join(trust, open_, "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "trust", "distrust"
    )


def op5_url_trust(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
