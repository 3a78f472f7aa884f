"""URL filter: rules by host and path, and for what no rule fits, trust and distrust that follow links between hosts.

Hosts whose pages the rules allow or block are seeds. Trust is a personalised PageRank from the allowed seeds
along links; distrust is one from the blocked seeds against them: who links to blocked hosts is distrusted. Links to
addresses that the rules judge make seeds too, so that hosts without pages in the table count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import pin

# The rules all judgements begin with, as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING, TOLERANCE = 0.85, 1e-3
MAX_DISTRUST = 0.5
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute links and those without a scheme; all others stay on their host.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?(//[^/?#"'\s<>][^"'\s<>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and for one without ``://``."""
    after = url.substr(F.instr(url, "://") + 3, F.length(url))
    rest = F.when(F.instr(url, "://") > 0, after).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """(rule, verdict) of the longest fitting rule, the earlier one of two as long; null where none fits."""
    fit = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rule_path)
        fit = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def host_links(pages: DataFrame, rules: tuple[tuple[str, str], ...], html_col: str = "html") -> DataFrame:
    """Links between different hosts, one row per pair: ``n``, the source's pages with a link to the target, ``linked``, the
    different addresses and verdicts of these links, and how many of them rules allow (``allowed``) or block (``blocked``)."""
    urls = F.array_distinct(F.regexp_extract_all(html_col, F.lit(LINK), 1))
    parts = F.transform(urls, lambda u: F.struct(*(p.alias(n) for p, n in zip(host_and_path(F.concat(F.lit("http:"), u)), ("host", "path"), strict=True))))
    judged = F.transform(parts, lambda p: F.struct(p["host"].alias("target"), rule_for(p["host"], p["path"], rules)["verdict"].alias("verdict"), F.lit(False).alias("page")))
    hosts = F.transform(
        F.array_distinct(F.transform(parts, lambda p: p["host"])),
        lambda h: F.struct(h.alias("target"), F.lit(None).cast("string").alias("verdict"), F.lit(True).alias("page")),
    )
    links = pages.filter("host <> ''").select(F.col("host").alias("source"), F.explode(F.concat(hosts, judged)).alias("link"))
    links = links.select("source", "link.*").filter("target <> source")
    return links.groupBy("source", "target").agg(
        F.count_if("page").alias("n"),
        F.count_if(~F.col("page")).alias("linked"),
        F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked"),
    )


def host_edges(pairs: DataFrame) -> DataFrame:
    """Links between hosts with ``share``, the part of the source's links a pair has, and ``back``, the part of the target's."""
    given = pairs.groupBy("source").agg(F.sum("n").alias("given"))
    got = pairs.groupBy("target").agg(F.sum("n").alias("got"))
    return pairs.join(given, "source").join(got, "target").selectExpr(
        "source", "target", "n / given as share", "n / got as back"
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of hosts: ``seeds`` (host, seed), ``edges`` (source, target, share).

    A score is the seed and ``damping`` times what links pass on: PageRank over its chance of a restart, so that a
    host without links keeps its own seed. What a host without links is passed goes no further. Rounds end
    when no score changed by more than ``tolerance``. As the shares of a source are at most 1 together, all changes of a
    round together are at most ``damping`` times those of the one before, so rounds grow with the logarithm of the seeds.
    Each round is written, since the next one reads it twice.
    """
    scores = seeds.select("host", F.col("seed").alias("score"))
    if edges.isEmpty():
        return scores
    while True:
        passed = (
            edges.join(scores.filter("score > 0"), edges.source == F.col("host"))
            .groupBy(F.col("target").alias("host"))
            .agg(F.sum(F.col("score") * F.col("share")).alias("passed"))
        )
        both = seeds.join(passed, "host", "full").join(scores, "host", "left")
        new = both.select(
            "host",
            (F.coalesce("seed", F.lit(0.0)) + damping * F.coalesce("passed", F.lit(0.0))).alias("next"),
            "score",
        )
        new = pin(new, "scores")
        largest = new.agg(F.max(F.abs(F.col("next") - F.coalesce("score", F.lit(0.0))))).first()[0]
        scores = new.select("host", F.col("next").alias("score"))
        if largest is None or largest <= tolerance:
            return scores


def judge_pages(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    max_distrust: float = MAX_DISTRUST,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Judge every page: id, ``host``, ``path``, ``rule`` (null where none fits), ``verdict``, ``trust``, ``distrust``.

    Without a rule a page gets its host's verdict: block where distrust exceeds both trust and ``max_distrust``.
    A seed's weight is the part of the host's pages that rules allow or block, or that of the links of other hosts to it
    where this is larger.

    Null urls and urls without ``://`` have an empty host and path, fit no rule, get no score and are allowed. Null
    html has no links. Repeated rows are judged as often as they come and count as pages of their host. Null ids stay
    null; an empty table gives an empty table; other columns are not read. Only narrow rows are shuffled; the table
    of hosts meets the pages under a salt, so that a host with a third of all pages is split.
    """
    host, path = host_and_path(F.col(url_col))
    read = pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    ruled = read.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    hosts = ruled.filter("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == "allow").cast("double")).alias("allowed"),
        F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == "block").cast("double")).alias("blocked"),
    )
    pairs = pin(host_links(read, rules), "host-links")
    to = pairs.groupBy(F.col("target").alias("host")).agg(F.sum("linked").alias("n"), F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    to = to.select("host", (F.col("a") / F.col("n")).alias("to_allowed"), (F.col("b") / F.col("n")).alias("to_blocked"))
    hosts = hosts.join(to, "host", "full").select("host", *(F.greatest(c, f"to_{c}").alias(c) for c in ("allowed", "blocked")))
    hosts, edges = pin(hosts, "hosts"), pin(host_edges(pairs), "host-edges")
    trust = propagate(hosts.selectExpr("host", "allowed as seed"), edges)
    against = edges.selectExpr("target as source", "source as target", "back as share")
    distrust = propagate(hosts.selectExpr("host", "blocked as seed"), against)
    scored = hosts.select("host").join(trust.withColumnRenamed("score", "trust"), "host", "left")
    scored = scored.join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
    scored = pin(scored, "host-scores").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    salted = ruled.drop("html").withColumn("salt", F.pmod(F.xxhash64("page", "path"), F.lit(SALTS)).cast("int"))
    bad = (F.col("distrust") > max_distrust) & (F.col("distrust") > F.col("trust"))
    return salted.join(scored, ["host", "salt"], "left").select(
        F.col("page").alias(id_col),
        "host",
        "path",
        "fit.rule",
        F.coalesce("fit.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "trust",
        "distrust",
    )
