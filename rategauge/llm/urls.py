"""Judge urls by rules, and by a tree of path templates learnt per host.

Static step: a segment of the path that varies by nature (digits, long hex, very long) is a
wildcard. Counts are taken per host and static template, and all that follows works on that much
smaller table. The tree is then built level by level, each below the branches of the one before: a
literal segment with less than ``1 / branches`` of its parent's pages becomes a wildcard too, so what
stands below rare segments is counted together; and siblings whose share of bad labels does not differ
from that of the others (two-sided z below ``z``) are one branch, whose subtrees share their counts.
Templates show the wildcards, not the merges. A template is rejected where its branch's share of good
labels, smoothed towards its host's and that towards the share of all, is below ``purity``.
A tree has at most ``DEPTH`` levels; what is deeper is one segment.

Built from SQL functions only. Counts are summed per task before the shuffle, so a host with a third
of all pages is not gathered; joins have one row per template or parent on one side, and AQE splits
the other. Rules are a parameter: up to ``INLINE_RULES`` are compiled to one expression, more are joined
by the host and the domains above it.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is
judged by the template of the empty host; rows that repeat count each; a label table may hold an id
more than once (bad if any row is bad); an empty table gives an empty result; columns other than id
and url play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rategauge.llm.text import lower_ascii
from rategauge.plans.scratch import stored

INLINE_RULES = 500
DEPTH = 8


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host(url: str) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Sequence[Rule]) -> Column:
    """``struct(name, verdict)`` of the longest rule that fits ``host`` and ``path``, or null."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits &= F.col("path").startswith(rule.path)
        found.append(F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<name:string,verdict:string>")
    return F.coalesce(*found, none)


def with_longest_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``hit`` as :func:`longest_rule` gives it, for any number of rules."""
    if len(rules) <= INLINE_RULES:
        return df.withColumn("hit", longest_rule(rules))
    table = df.sparkSession.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "domain string, start string, name string, verdict string")
    found = F.collect_list(F.struct((-F.length("name")).alias("order"), "name", "verdict", "start")).alias("found")
    parts = F.split("host", "[.]", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = df.select("host").distinct().withColumn("domain", F.explode(above))
    of_host = hosts.join(table.groupBy("domain").agg(found), "domain").groupBy("host").agg(F.flatten(F.collect_list("found")).alias("found"))
    best = F.array_min(F.filter("found", lambda r: F.col("path").startswith(r["start"])))
    hit = F.when(best.isNotNull(), F.struct(best["name"].alias("name"), best["verdict"].alias("verdict")))
    return df.join(of_host, "host", "left").withColumn("hit", hit).drop("found")


def static_template(path: str) -> Column:
    """The path with segments that vary by nature as wildcards; a file ending stays."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")

    def general(s: Column) -> Column:
        ending = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        varies = s.rlike("[0-9]") | s.rlike("^[A-Fa-f]{12,}") | (F.length(s) > 40)
        return F.when(varies, F.concat(F.lit("*"), ending)).otherwise(s)

    return F.transform(segments, general)


def _grown(counts: DataFrame, branches: int, z: float) -> DataFrame:
    """``counts`` with ``template`` and ``branch`` of each static template, one stored table per level."""
    deep = F.concat(F.slice("static", 1, DEPTH - 1), F.array(F.array_join(F.slice("static", DEPTH, F.size("static")), "/")))
    tree = F.when(F.size("static") > DEPTH, deep).otherwise(F.col("static"))
    none = F.array().cast("array<string>")
    rows = counts.withColumns({"tree": tree, "template": none, "branch": none})
    one, parent = F.lit(1), ["host", "branch"]
    for level in range(1, (rows.agg(F.max(F.size("tree"))).first()[0] or 0) + 1):
        rows = rows.withColumn("segment", F.try_element_at("tree", F.lit(level)))
        share = rows.where("segment IS NOT NULL").groupBy(*parent, "segment").agg(*(F.sum(c).alias(c) for c in "nmb"))
        whole = share.groupBy(*parent).agg(*(F.sum(c).alias(f"all_{c}") for c in "nmb"))
        rare = F.col("n") * branches < F.col("all_n")
        share = share.join(whole, parent).withColumn("name", F.when(rare, F.lit("*")).otherwise(F.col("segment")))
        arcs = share.groupBy(*parent, "name").agg(F.sum("m").alias("m"), F.sum("b").alias("b"), *(F.first(f"all_{c}").alias(f"all_{c}") for c in "mb"))
        others, pooled = F.col("all_m") - F.col("m"), F.try_divide("all_b", "all_m")
        gap = F.abs(F.try_divide("b", "m") - F.try_divide(F.col("all_b") - F.col("b"), others))
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, F.col("m")) + F.try_divide(one, others)))
        alike = F.coalesce(gap <= z * spread, F.lit(True))  # nothing labelled here or elsewhere: alike
        arcs = arcs.select(*parent, "name", F.when(alike, F.lit("~")).otherwise(F.col("name")).alias("arc"))
        steps = share.select(*parent, "segment", "name").join(arcs, [*parent, "name"])
        rows = rows.join(steps, [*parent, "segment"], "left")
        grown = {c: F.when(F.col(s).isNull(), F.col(c)).otherwise(F.concat(c, F.array(s))) for c, s in (("template", "name"), ("branch", "arc"))}
        rows = stored(rows.withColumns(grown).drop("segment", "name", "arc"), "level")
    return rows


def template_verdicts(
    pages: DataFrame,
    branches: int = 50,
    z: float = 1.96,
    prior: float = 10.0,
    purity: float = 0.5,
) -> DataFrame:
    """``(host, static, template, purity, verdict)`` from ``pages(host, static, bad)``.

    ``bad`` is 1 or 0 where a page is labelled, else null. The templates are counted once and stored.
    """
    counts = stored(
        pages.groupBy("host", "static").agg(
            F.count("*").alias("n"), F.count("bad").alias("m"), F.sum("bad").alias("b")
        ).withColumn("b", F.coalesce("b", F.lit(0)).cast("double")),
        "templates",
    )
    counts = _grown(counts, branches, z)
    merged = counts.groupBy("host", "branch").agg(F.sum("m").alias("bm"), F.sum("b").alias("bb"))
    of_host = counts.groupBy("host").agg(F.sum("m").alias("hm"), F.sum("b").alias("hb"))
    labelled, bad = counts.agg(F.sum("m"), F.sum("b")).first()
    labelled, bad = labelled or 0, bad or 0.0
    judged = merged.join(of_host, "host")
    every = F.lit((labelled - bad + 1) / (labelled + 2))
    in_host = (F.col("hm") - F.col("hb") + prior * every) / (F.col("hm") + prior)
    good = (F.col("bm") - F.col("bb") + prior * in_host) / (F.col("bm") + prior)
    judged = judged.select("host", "branch", good.alias("purity"))
    verdict = F.when(F.col("purity") < purity, F.lit("block")).otherwise(F.lit("allow"))
    shown = F.concat(F.lit("/"), F.array_join("template", "/"))
    return (
        counts.select("host", "static", "template", "branch")
        .join(judged, ["host", "branch"])
        .select("host", "static", shown.alias("template"), "purity", verdict.alias("learnt"))
    )


def judged_urls(
    pages: DataFrame,
    labels: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``(id, host, path, rule, verdict, template, purity)`` of every url.

    A page that a rule decides is a labelled one for the tree; others are where ``labels(id, bad)``
    has them.
    """
    df = pages.select(F.col(id).alias("id"), host(url).alias("host"), path(url).alias("path"))
    df = with_longest_rule(df.withColumn("static", static_template("path")), rules)
    if labels is None:
        df = df.withColumn("labelled", F.lit(None).cast("int"))
    else:
        once = labels.groupBy("id").agg(F.max("bad").alias("labelled"))
        df = df.join(once, "id", "left")
    by_rule = F.when(F.col("hit").isNotNull(), (F.col("hit.verdict") == "block").cast("int"))
    df = stored(df.withColumn("bad", F.coalesce(by_rule, "labelled")), "urls")
    learnt = template_verdicts(df)
    return df.join(learnt, ["host", "static"]).select(
        F.col("id").alias(id),
        "host",
        "path",
        F.col("hit.name").alias("rule"),
        F.coalesce("hit.verdict", "learnt").alias("verdict"),
        "template",
        "purity",
    )
