"""URL filters: rules first, then trust and distrust propagated over the links between hosts.

Rules are (verdict, "host/path") pairs: a rule fits its host and all subdomains if the url's path
starts with the rule's path; the longest rule wins. The hosts of pages that a rule allows are the
trusted seeds and those of pages that a rule blocks the blocked seeds, weighted by such pages.
Personalised PageRank spreads trust from the trusted seeds along the links, and distrust from the
blocked seeds against them. A page without a rule is allowed if its host's trust is at least
``ratio`` times its distrust (a host that neither reaches is allowed).

Edges are the distinct host pairs of absolute links in the pages' html, weighted by pages; a host's
links to itself are left out (hosts are compared without user part and port; the output keeps both), and the mass of hosts without links returns to the seeds. Both
directions advance together; every ``cut_every`` steps lineage is cut by checkpoint(), and propagation
ends when no new host was reached since the last cut and the summed change since then is at most
``tolerance`` (1e-9) of the seeds' mass, for trust and distrust each.

Defined results: null url or no "://": host and path are empty and no rule fits. Null html has no
links. Repeated pages each get a row and count twice as seeds and links. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.session import ensure_checkpoint_dir

# href or src with an absolute or scheme-relative url; group 1 is the host with its port
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null without one). ``rules`` is a bounded driver-side list."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # longer rules are tested first
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def plain_host(host: Column) -> Column:
    """A host without its user part and port."""
    return F.regexp_extract(F.regexp_replace(host, r"^[^@]*@", ""), r"^([^:]*)", 1)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n (pages of src that link to dst) from rows (host, html)."""
    links = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    out = pages.select(F.col("host").alias("src"), F.explode(links).alias("to"))
    target = ascii_lower(plain_host(F.col("to")))
    out = out.select("src", target.alias("dst")).where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return out.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = 1e-9, damping: float = 0.85, cut_every: int = 5) -> DataFrame:
    """host, trust, distrust from ``edges`` (src, dst, n) and ``seeds`` (host, allowed, blocked), converged."""
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionAll(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "n"))
    out_n = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    both = both.join(out_n, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")).checkpoint()
    start = seeds.select(F.lit("trust").alias("kind"), "host", F.col("allowed").alias("seed")).unionAll(
        seeds.select(F.lit("distrust"), "host", F.col("blocked"))).where("seed > 0")
    start = start.select("kind", "host", F.col("seed").cast("double").alias("value")).checkpoint()
    mass = {r["kind"]: r["n"] for r in start.groupBy("kind").agg(F.sum("value").alias("n")).collect()}
    rank, settled = start, not mass
    while not settled:
        before = rank
        for _ in range(cut_every):
            moved = both.join(rank.select("kind", F.col("host").alias("src"), "value"), ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), (damping * F.col("share") * F.col("value")).alias("value"))
            stay = start.select("kind", "host", ((1 - damping) * F.col("value")).alias("value"))
            rank = moved.unionAll(stay).groupBy("kind", "host").agg(F.sum("value").alias("value"))
        rank = rank.checkpoint()
        moves = before.withColumnRenamed("value", "old").join(rank, ["kind", "host"], "full").groupBy("kind").agg(
            F.sum(F.abs(F.coalesce("value", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))).alias("change"),
            F.count_if(F.col("old").isNull()).alias("reached")).collect()
        settled = all(r["reached"] == 0 and r["change"] <= tolerance * mass[r["kind"]] for r in moves)
    # Mass that reached a host without links is missing: returning it to the seeds only scales the ranks.
    total = {r["kind"]: r["n"] for r in rank.groupBy("kind").agg(F.sum("value").alias("n")).collect()}
    share = {kind: F.sum(F.when(F.col("kind") == kind, F.col("value")).otherwise(0.0)) / F.lit(total.get(kind) or 1.0)
             for kind in ("trust", "distrust")}
    return rank.groupBy("host").agg(share["trust"].alias("trust"), share["distrust"].alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", tolerance: float = 1e-9, ratio: float = 1.0) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (allow or block), trust and distrust of its host."""
    host, path = url_parts(F.col(url_col))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    judged = src.select("page_id", "host", "path", rule.alias("rule"), said.alias("said"), plain_host(F.col("host")).alias("plain"))
    seeds = judged.where("plain != ''").groupBy(F.col("plain").alias("host")).agg(
        F.count_if(F.col("said") == "allow").alias("allowed"), F.count_if(F.col("said") == "block").alias("blocked"))
    hosts = propagate(host_edges(src.select(plain_host(F.col("host")).alias("host"), "html")), seeds, tolerance).select(F.col("host").alias("on"), "trust", "distrust")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when(trust >= ratio * distrust, F.lit("allow")).otherwise(F.lit("block"))
    return judged.join(hosts, judged["plain"] == hosts["on"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
