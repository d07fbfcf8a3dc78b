"""URL rules, and trust and distrust propagated over the link graph of hosts.

Rules allow or block a host with all its subdomains under a path; the longest that fits
decides. Pages that no rule fits get their host's verdict: trust is personalised PageRank
from the hosts of allowed pages along links, distrust the same from the hosts of blocked
pages against links (who links to a blocked host is suspect). Seeds weigh by their pages.
A host is blocked when its distrust exceeds TOLERANCE times its trust.

Links are counted per pair of hosts first, so the graph has one row per pair, however
many pages stand behind it; links within a host say nothing and are left out. Ranks of
hosts without outgoing links flow back to the seeds. Rounds go on until no rank moves by
SETTLED: a rank then differs from its limit by less than SETTLED / (1 - DAMPING), below the
digits that are compared. A round shrinks all changes together by DAMPING, so this takes
fewer than MAX_ROUNDS rounds on any graph. Every few rounds the ranks are written to the
shared work folder, which cuts the lineage.

Null urls and urls without ``://`` have an empty host and path, match no rule and are
allowed. Null pages have no links. Repeated rows count as pages of their own. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.llm.text import spare_name
from candleworks.session import staged

DAMPING = 0.85
#: Well beyond ln(SETTLED) / ln(DAMPING) = 184 rounds, so that the ranks have settled by then.
MAX_ROUNDS = 210
#: Rounds between two written copies of the ranks.
WRITE_EVERY = 5
#: Largest change of a rank over the rounds between two copies at which the ranks count as settled.
SETTLED = 1e-13
TOLERANCE = 1.0
#: Ranks are compared to this many digits, so that the order of sums doesn't matter.
DIGITS = 12
#: Rules are part of the plan; more of them belong in a table.
MAX_RULES = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """pattern: a host, and from the first slash on a path; verdict: allow or block."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


#: The rules of the registered query.
RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, or null.

    The host's suffixes are looked up in a map of the rules' hosts. Of rules of equal
    length the one that sorts last wins.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    kind = "struct<size:int,rule:string,verdict:string,path:string>"
    if not rules:
        return F.lit(None).cast(kind)
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)

    def literal(rule: Rule) -> Column:
        fields = {"size": len(rule.pattern), "rule": rule.pattern, "verdict": rule.verdict, "path": rule.path}
        return F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])

    known = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*map(literal, own)))])
    labels = F.size(F.split(host, r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), labels), lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    fitting = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.element_at(known, s), F.array().cast(f"array<{kind}>"))))
    return F.array_max(F.filter(fitting, lambda r: F.startswith(path, r["path"])))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts; relative links stay on their host."""
    urls = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("href"))
    absolute = F.when(F.startswith(F.col("href"), F.lit("//")), F.concat(F.lit("http:"), "href")).otherwise(F.col("href"))
    targets = urls.where(F.col("href").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//")).select("src", host_of(absolute).alias("dst"))
    between = targets.where("src != '' and dst != '' and src != dst")
    return between.groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = MAX_ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, rank) from seeds (kind, host, weight) over links (kind, src, dst, links).

    Each kind is a graph of its own; weights and links need not be normalised.
    """
    totals = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = seeds.join(totals, "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("seed"))
    start = staged(start, "seeds")
    out = links.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    edges = staged(
        links.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("links") / F.col("all")).alias("share")),
        "links",
    )
    if edges.isEmpty():  # nothing to propagate: all rank flows back to the seeds
        return start.select("kind", "host", F.col("seed").alias("rank"))
    # What is not passed on returns to the seeds in fixed shares, so the ranks are, but for a
    # factor, what the seeds send along all walks: x = seed + DAMPING * (x along links).
    own = start.select("kind", "host", F.col("seed").alias("rank"))
    ranks = before = own
    for i in range(1, rounds + 1):
        sent = edges.join(ranks, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        ranks = sent.unionByName(own).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % WRITE_EVERY == 0 or i == rounds:
            ranks = staged(ranks, "ranks")
            moved = ranks.join(before.withColumnRenamed("rank", "old"), ["kind", "host"], "left").agg(
                F.max(F.col("rank") - F.coalesce("old", F.lit(0.0)))
            )
            if (moved.first()[0] or 0.0) < SETTLED:
                whole = ranks.groupBy("kind").agg(F.sum("rank").alias("whole"))
                return ranks.join(whole, "kind").select("kind", "host", (F.col("rank") / F.col("whole")).alias("rank"))
            before = ranks
    raise RuntimeError(f"ranks have not settled after {rounds} rounds")


def host_verdicts(judged: DataFrame, pages: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, blocked) of all hosts with a rank; judged: host, rule_verdict."""
    seeds = judged.where("rule_verdict is not null and host != ''").groupBy("rule_verdict", "host").agg(
        F.count("*").alias("weight")
    )
    kind = F.when(F.col("rule_verdict") == "allow", F.lit("trust")).otherwise(F.lit("distrust"))
    found = staged(host_links(pages), "host-links")
    forward = found.select(F.lit("trust").alias("kind"), "src", "dst", "links")
    reverse = found.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    ranks = propagate(seeds.select(kind.alias("kind"), "host", "weight"), forward.unionByName(reverse))

    def of(name: str) -> Column:
        return F.round(F.sum(F.when(F.col("kind") == name, F.col("rank")).otherwise(0.0)), DIGITS).alias(name)

    both = ranks.groupBy("host").agg(of("trust"), of("distrust"))
    return both.withColumn("blocked", F.col("distrust") > tolerance * F.col("trust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = parts.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    judged = found.select("page_id", "host", "path", F.col("match.rule").alias("rule"), F.col("match.verdict").alias("rule_verdict"))
    hosts = host_verdicts(judged, pages, tolerance)
    by_host = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def allowed(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The pages that are not blocked, with all their columns."""
    keep = spare_name(pages, "host")
    match = matching_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    judged = pages.select(host_of(F.col("url")).alias("host"), match["verdict"].alias("rule_verdict"))
    blocked = host_verdicts(judged, pages).where("blocked").select(F.col("host").alias(keep))
    tested = pages.withColumn(keep, host_of(F.col("url")))
    ruled = tested.where(match["verdict"] == "allow")
    rest = tested.where(match["verdict"].isNull()).join(blocked, keep, "left_anti")
    return ruled.unionByName(rest).select(*pages.columns)
