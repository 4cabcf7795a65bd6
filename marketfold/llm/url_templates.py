"""URL filter by rules and by path templates.

Rules (host and path prefix) decide first; the longest that fits wins.  URLs
that no rule fits are judged by the template they fall under.  Per host the
paths form a tree by segments.  Level by level a segment stays literal only if
the labelled verdicts below it are enough for the test and differ significantly
from those of the node; statistically similar branches merge into a wildcard.
Levels go on while a node below the first ``LEVELS`` still has labels of both
kinds: under any other no branch can differ.  A template is rejected by the
share of blocked labels under it, smoothed towards its host's, and that
towards the domain's and the whole table's; without a blocked label under its
domain nothing speaks against it and it is allowed.

Labels are the verdicts of the rules (or any labelled URLs given).

Scale: one aggregation per level over distinct (host, path); the branches that
stay literal are joined back by sort-merge, so a host
with a third of all pages is summed up map-side and split in joins.

Defined results: null, or no ``://``: host and path are empty, no rule fits
and the verdict is that of the empty template; repeated pages are judged one
by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import LOWER, UPPER
from marketfold.session import cut_lineage

LEVELS = 8             # deeper ones are looked at while labels under a node differ
MIN_LABELS = 5         # below a branch, for the test to hold
SIGNIFICANT = 2.0      # standard deviations from the node's share
SMOOTHING = 4.0        # labels that the wider share is worth
REJECT = 0.6


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (Rule(True, "org", "/"), Rule(False, "example.org", "/es/"), Rule(False, "example.org", "/en/1"),
         Rule(True, "com", "/fr/"), Rule(False, "com", "/de/"))


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` plus ``host`` and ``path`` of the url."""
    text = F.col(url).cast("string")
    at = F.coalesce(F.instr(text, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    df = pages.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.substr(F.col("_rest"), F.length("_host") + 1), "^[^?#]*", 0)
    return df.withColumn("path", path).withColumn("host", F.translate("_host", UPPER, LOWER)).drop("_rest", "_host")


def rule_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the longest rule that fits ``host`` and ``path``, else null."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        found = F.when(fits, F.lit(r.name)) if found is None else found.when(fits, F.lit(r.name))
    return F.lit(None).cast("string") if found is None else found


def rule_blocks(name: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether the named rule blocks; null without a rule."""
    return F.when(name.isin([r.name for r in rules if not r.allow]), True).when(name.isNotNull(), False)


def templates(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(host, path, n, labelled, blocked) -> the same plus ``template``."""
    segments = F.slice(F.split("path", "/"), 2, 2**31 - 1)
    state = cut_lineage(paths.withColumn("_segs", segments).withColumn("template", F.lit("")), "url-level")
    deepest, depth = state.agg(F.max(F.size("_segs"))).first()[0] or 0, 0
    while depth < deepest and (depth < levels or _may_differ(state, depth)):
        state, depth = cut_lineage(_level(state, depth), "url-level"), depth + 1
    tail = F.when(F.size("_segs") > depth, F.lit("/**")).otherwise(F.lit(""))
    return state.withColumn("template", F.concat("template", tail)).drop("_segs")


def _may_differ(state: DataFrame, depth: int) -> bool:
    """Whether a node that goes on has labels of both kinds."""
    node = state.filter(F.size("_segs") > depth).groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    return not node.filter((F.col("l") >= MIN_LABELS) & (F.col("b") > 0) & (F.col("b") < F.col("l"))).isEmpty()


def _level(state: DataFrame, depth: int) -> DataFrame:
    """Append one segment, literal or wildcard, to every template that goes on."""
    state = state.withColumn("_seg", F.get("_segs", F.lit(depth)))
    branch = state.filter("_seg IS NOT NULL").groupBy("host", "template", "_seg").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    branch = cut_lineage(branch, "url-branches")
    node = branch.groupBy("host", "template").agg(F.sum("labelled").alias("all_l"), F.sum("blocked").alias("all_b"),
                                                 F.count(F.lit(1)).alias("kinds"))
    share = F.try_divide(F.col("all_b"), F.col("all_l"))
    spread = F.sqrt(F.greatest(F.col("labelled") * share * (1 - share), F.lit(1e-12)))
    differs = F.abs(F.col("blocked") - F.col("labelled") * share) > SIGNIFICANT * spread
    literal = branch.join(cut_lineage(node, "url-nodes"), ["host", "template"]).filter(
        (F.col("kinds") == 1) & (F.col("n") >= 2) | (F.col("labelled") >= MIN_LABELS) & differs)
    literal = cut_lineage(literal.select("host", "template", "_seg", F.lit(True).alias("_stays")), "url-literal")
    joined = state.join(literal, ["host", "template", "_seg"], "left")
    step = F.when(F.col("_seg").isNull(), F.lit("")).when(F.col("_stays"), F.concat(F.lit("/"), F.col("_seg"))).otherwise(F.lit("/*"))
    return joined.withColumn("template", F.concat("template", step)).drop("_seg", "_stays")


def smoothed(own_b: str, own_l: str, wider: Column) -> Column:
    return (F.col(own_b) + F.lit(SMOOTHING) * wider) / (F.col(own_l) + F.lit(SMOOTHING))


def with_purity(paths: DataFrame) -> DataFrame:
    """(host, path, template ...) -> (host, path, template, purity, evidence):
    the smoothed share of blocked labels under the template, and whether there
    is a blocked label under its domain at all."""
    sums = [F.sum("labelled").alias("l"), F.sum("blocked").alias("b")]
    domain = F.substring_index("host", ".", -2)
    whole = paths.agg(*sums).first()
    overall = (whole["b"] or 0) / whole["l"] if whole["l"] else 0.0
    leaf = cut_lineage(paths.groupBy("host", "template").agg(*sums), "url-templates")
    hosts = leaf.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb")).withColumn("domain", domain)
    domains = hosts.groupBy("domain").agg(F.sum("hl").alias("dl"), F.sum("hb").alias("db"))
    hosts = hosts.join(domains, "domain").select("host", smoothed("hb", "hl", smoothed("db", "dl", F.lit(overall))).alias("host_purity"), (F.col("db") > 0).alias("evidence"))
    leaf = leaf.join(cut_lineage(hosts, "url-hosts"), "host").select("host", "template", smoothed("b", "l", F.col("host_purity")).alias("purity"), "evidence")
    return paths.join(cut_lineage(leaf, "url-leaf"), ["host", "template"]).select("host", "path", "template", "purity", "evidence")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of pages
    (page_id, url).  ``labels`` (host, path, blocked 0/1) replaces the rules'
    own verdicts as the labelled sample."""
    parsed = with_host_path(pages.select("page_id", "url")).withColumn("rule", rule_of(rules)).drop("url")
    parsed = cut_lineage(parsed, "url-pages")
    blocks = rule_blocks(F.col("rule"), rules)
    if labels is None:
        paths = parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count(blocks).alias("labelled"), F.count_if(blocks).alias("blocked"))
    else:
        given = labels.groupBy("host", "path").agg(F.count(F.lit(1)).alias("labelled"), F.sum("blocked").alias("blocked"))
        paths = parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).join(given, ["host", "path"], "left").fillna(0, ["labelled", "blocked"])
    judged = cut_lineage(with_purity(templates(paths)), "url-judged")
    own = F.coalesce((F.col("purity") >= REJECT) & F.col("evidence"), F.lit(False))
    verdict = F.when(F.coalesce(blocks, own), F.lit("block")).otherwise(F.lit("allow"))
    return parsed.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
