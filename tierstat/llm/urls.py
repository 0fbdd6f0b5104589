"""URL filters: host and path rules, and link-graph propagation for what no rule fits.

Trust is a personalised PageRank from the hosts of pages that a rule allows;
distrust is the same over reversed links from the hosts of pages that a rule
blocks.  Both go on until the scores have settled.  Both walk the host graph: links found in the pages, and a step
between a host and its parent domain where both are hosts of the tables.  A
page that no rule fits is blocked if distrust has more than ``THRESHOLD`` of
its host's trust and distrust, and allowed otherwise (also without either).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstat.llm.common import lower_ascii, written

DAMPING = 0.85
CHECKED = 4  # steps from one check of the scores to the next
SETTLED = 1e-9  # largest summed change between two checks, of a mass of 1 each for trust and distrust
MOST_STEPS = 10_000
THRESHOLD = 0.5
_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)[\s"'](?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, null if none does.  The list is short: no join."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)

    def first(of) -> Column:
        return reduce(lambda c, r: c.when(fits(r), F.lit(of(r))), ordered, F).otherwise(F.lit(None).cast("string"))

    if not ordered:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return first(lambda r: r.name), first(lambda r: r.verdict)


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """Rows (src, dst, n): links between different hosts, and steps between a host and its parent domain."""
    links = pages.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("to"))
    links = links.select("src", lower_ascii(F.col("to")).alias("dst"))
    links = links.where((F.col("src") != "") & (F.col("dst") != F.col("src"))).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    links = written(links, "links")
    hosts = pages.select(F.col(host).alias("h")).where("h != ''").unionByName(links.select(F.col("dst").alias("h"))).distinct()
    hosts = written(hosts, "hosts")
    parents = hosts.select("h", F.regexp_extract("h", r"^[^.]*\.(.+)$", 1).alias("p")).join(
        hosts.select(F.col("h").alias("p")), "p", "left_semi"
    )
    up = parents.select(F.col("h").alias("src"), F.col("p").alias("dst"), F.lit(1).cast("long").alias("n"))
    down = parents.select(F.col("p").alias("src"), F.col("h").alias("dst"), F.lit(1).cast("long").alias("n"))
    return links.unionByName(up).unionByName(down).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int | None = None) -> DataFrame:
    """Rows (kind, host, score) of personalised PageRank from ``seeds`` (kind, host, mass).

    Steps go on until the scores and the set of reached hosts have settled (an error if they have not after
    ``MOST_STEPS``), or for just ``steps`` steps.
    Kind "trust" follows the links, "distrust" runs against them.  A seed set's masses are made to
    sum to 1; what reaches a host without links leaves the walk.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    steps_out = written(
        both.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("p")), "steps"
    )
    mass = seeds.groupBy("kind").agg(F.sum("mass").alias("all"))
    seeds = written(seeds.join(mass, "kind").select("kind", "host", (F.col("mass") / F.col("all")).alias("score")), "seeds")
    scores, checked = seeds, None
    restart = seeds.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
    for step in range(1, (MOST_STEPS if steps is None else steps) + 1):
        moved = steps_out.join(scores, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("p") * damping).alias("score"))
        # Decimal sums do not depend on the order of their terms: reruns agree, and so do equal scores.
        exact = F.sum(F.col("score").cast("decimal(38,30)")).cast("double")
        scores = restart.unionByName(moved).groupBy("kind", "host").agg(exact.alias("score"))
        if step % CHECKED == 0 or step == steps:  # keep the plan short
            scores = written(scores, "scores")
            if steps is None and checked is not None and _settled(checked, scores):
                return scores
            checked = scores
    if steps is None:
        raise RuntimeError(f"link scores did not settle in {MOST_STEPS} steps")
    return scores


def _settled(old: DataFrame, new: DataFrame) -> bool:
    """The same hosts are reached (none is ever lost, so their number tells) and the scores hardly change."""
    both = old.select("kind", "host", F.col("score").alias("old")).join(new, ["kind", "host"], "full")
    change = F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))
    row = both.agg(F.count("old").alias("before"), F.count("score").alias("now"), change.alias("change")).first()
    return row["before"] == row["now"] and (row["change"] or 0.0) <= SETTLED


def judged_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, trust, distrust), one per row of ``pages``.

    A null url, or one without ``://``, has empty host and path, fits no rule,
    takes no part in the graph and is allowed.  Null html has no links.
    """
    parsed = pages.select(
        F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), F.col(html).alias("html")
    )
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": name, "by_rule": verdict})
    edges = host_edges(ruled, "host", "html")
    seeds = (
        ruled.where(F.col("rule").isNotNull())
        .groupBy(F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .agg(F.count(F.lit(1)).alias("mass"))
    )
    scores = propagate(edges, seeds)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = written(scores.groupBy("host").agg(of("trust"), of("distrust")), "judged")
    joined = ruled.drop("html").join(hosts, "host", "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when(distrust > (trust + distrust) * threshold, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )
