"""URL rules, and trust and distrust propagated over the links between hosts."""

from __future__ import annotations

import itertools
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.tables import staged

# Share of a score that is passed over links, and the change at which the rounds end.
DAMPING = 0.85
SETTLED = 1e-6
# Distrust of a host, as a share of what it would have with every page blocked, from which it is blocked.
THRESHOLD = 0.5

LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'>]*)"""


@dataclass(frozen=True)
class Rule:
    """``site`` is a host and the start of a path, like ``example.net/en/``; ``verdict`` is allow or block."""

    site: str
    verdict: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.site.partition("/")[2]


# The rules in force.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) after the first ``://``, and the path behind it; empty where there is none."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``(site, verdict)`` of the longest rule that fits the host, or one it is below, and the start of the path."""
    found = [
        F.when(
            ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path)),
            F.struct(F.lit(rule.site).alias("site"), F.lit(rule.verdict).alias("verdict")),
        )
        for rule in sorted(rules, key=lambda r: (-len(r.site), r.site))
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<site: string, verdict: string>")


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst, n)``: how many links the pages of one host have to another host."""
    source, _ = host_and_path(F.col(url))
    target = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    links = pages.select(source.alias("src"), target.alias("target"))
    links = links.withColumn("target", F.regexp_replace("target", r"^//", "http://"))
    named = links.select("src", host_and_path(F.col("target"))[0].alias("dst"))
    return named.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """``(kind, host, score)`` of two personalised PageRanks, from ``seeds(kind, host, weight)``.

    Kind ``trust`` walks along the links, ``distrust`` against them: who links to the distrusted is distrusted. The scores
    of a kind add up to 1; what reaches a host without further links goes back to the seeds. Each round is one join
    of scores and links and one sum, written to the shared scratch folder, until the scores have settled and no further
    host is reached (looked at after the first round and every fifth), or for so many ``rounds``.
    """
    along = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    against = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    edges = along.unionByName(against)
    out = edges.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    edges = staged(edges.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share")), "edges")
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = seeds.join(total, "kind").where(F.col("all") > 0)
    start = staged(start.select("kind", "host", (F.col("weight") / F.col("all")).alias("seed")).where("seed > 0"), "seeds")
    scores = start.select("kind", "host", F.col("seed").alias("score"))
    for round_ in itertools.count(1) if rounds is None else range(1, rounds + 1):
        passed = scores.join(edges, ["kind", "host"]).groupBy("kind", F.col("to").alias("host"))
        passed = passed.agg((damping * F.sum(F.col("score") * F.col("share"))).alias("score"))
        sums = passed.groupBy("kind").agg(F.least(F.lit(1.0), F.sum("score")).alias("given"))  # two rows at most
        back = start.join(F.broadcast(sums), "kind", "left").select(
            "kind", "host", ((1 - F.coalesce("given", F.lit(0.0))) * F.col("seed")).alias("score")
        )
        new = staged(passed.unionByName(back).groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
        settled = False
        if round_ == 1 or round_ % 5 == 0:
            before = scores.select("kind", "host", (-F.col("score")).alias("score"), F.lit(1).alias("old"))
            both = new.withColumn("old", F.lit(0)).unionByName(before)
            moved = both.groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("change"), F.max("old").alias("old"))
            change, reached = moved.agg(F.sum("change"), F.count_if(F.col("old") == 0)).first()
            settled = (change or 0.0) < SETTLED and not reached
        scores = new
        if settled:
            break
    return scores


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    threshold: float = THRESHOLD,
    rounds: int | None = None,
    url: str = "url",
    html: str = "html",
    id: str = "page_id",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` for every row of ``pages``.

    The longest rule that fits decides. Else the host does: trust starts at the hosts of allowed pages and distrust at
    those of blocked ones, in proportion to the pages, and both spread over links. A host's distrust is divided by
    what its pages would have if all were blocked and nothing were passed on (trust likewise); it is blocked if that is
    at least ``threshold`` and more than its trust. A host with neither, and a url without a host, is allowed. Rows
    with a null id stay; repeated rows count and stay.
    """
    host, path = host_and_path(F.col(url))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule)
    hosts = rows.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count(F.when(F.col("found.verdict") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("found.verdict") == "block", 1)).alias("distrust"),
    )
    hosts = staged(hosts, "hosts")
    kinds = F.stack(F.lit(2), F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust")).alias("kind", "weight")
    seeds = hosts.select("host", kinds).where("weight > 0")
    totals = hosts.agg(*(F.sum(c).cast("double").alias(c) for c in ("trust", "distrust"))).first()
    scores = propagate(seeds, staged(host_links(pages, url, html), "links"), rounds=rounds)
    wide = scores.groupBy("host").agg(
        *(F.sum(F.when(F.col("kind") == kind, F.col("score"))).alias(f"{kind}_score") for kind in ("trust", "distrust"))
    )

    def share(kind: str) -> Column:
        return F.coalesce(F.col(f"{kind}_score") * F.lit(totals[kind] or 0.0) / F.col("pages"), F.lit(0.0)).alias(kind)

    judged = hosts.select("host", "pages").join(wide, "host", "left").select("host", share("trust"), share("distrust"))
    judged = staged(judged, "judged")
    # One row for each host: Spark broadcasts its files if they are small, or splits the hot hosts of the pages.
    joined = rows.join(judged, "host", "left")
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce(F.col("found.verdict"), F.when(bad, F.lit("block")), F.lit("allow"))
    return joined.select(
        "page_id", "host", "path", F.col("found.site").alias("rule"), verdict.alias("verdict"), "trust", "distrust"
    )
