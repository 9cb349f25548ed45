"""URL filters with redirect equivalence, with DataFrame functions only.

A rule is a host and the beginning of a path with an action; it fits its host and all subdomains, the longest rule
wins, and an equally long allow rule precedes a block rule. What no rule judges is decided by equivalence: pages
are aliases if a redirect or canonical link leads from one to the other. A page is blocked if a block rule holds
for an alias of it, unless a rule allows the page itself: explicit allow precedes. All else is allowed.

Links come from the pages themselves (``<link rel=canonical>``, ``<meta http-equiv=refresh>``) and, if given, from a
table of redirects. Links of a page may be absolute, begin with ``//``, ``/`` or ``?``, or be relative to its folder (dots
are resolved), and ``&amp;`` stands for ``&``; other schemes, empty links and bare fragments lead nowhere, and a ``<base>``
is not looked at. An address without its scheme and fragment is a node;
components are found by distributed stars, so a host or an alias group of any size is split. Rules are joined by
host suffix, one equality join for each number of labels among the rules; they are broadcast only if there are at
most ``BROADCAST_RULES``.

Null urls and such without ``://`` have an empty host and path, no rule and no alias. Null html holds no link.
Repeated rows give a row each. Without rules every page is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.llm.components import connected_components
from wearcurve.sources.tables import materialize

BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none or the url is null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), "^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The address as a node: host, path and query; null if there is no host."""
    host = host_of(url)
    tail = F.regexp_extract(rest_of(url), "^[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(F.substring(tail, 1, 1) == "/", tail).otherwise(F.concat(F.lit("/"), tail))))


def _without_dots(path: Column) -> Column:
    """A path from ``/`` on with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        none,
        lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.concat(a, F.array(x))),
    )
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, ends), "/"))


def target_of(link: Column, url: Column) -> Column:
    """The node that a link on the page ``url`` leads to; null if there is none."""
    to = F.trim(F.regexp_replace(link, "(?i)&(amp|#38|#x26);", "&"))
    host = host_of(url)
    path, asked = F.regexp_extract(to, "^[^?#]*", 0), F.regexp_extract(to, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(url), "^/(.*/)?[^/]*$", 1))
    inside = (
        F.when(F.startswith(to, F.lit("/")), F.concat(_without_dots(path), asked))
        .when(F.startswith(to, F.lit("?")), F.concat(F.when(path_of(url) == "", "/").otherwise(path_of(url)), asked))
        .otherwise(F.concat(_without_dots(F.concat(folder, path)), asked))
    )
    return (
        F.when((to == "") | F.startswith(to, F.lit("#")), F.lit(None).cast("string"))
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(to.rlike("^[^:]*://"), node_of(to)))
        .when(F.startswith(to, F.lit("//")), node_of(F.concat(F.lit("http:"), to)))
        .when(host != "", F.concat(host, inside))
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (action, host, path) as a table."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def links_of(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) between the nodes of pages and what their canonical and refresh links name."""
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_LINK), 0), lambda x: x.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")),
        lambda x: F.regexp_extract(x, _HREF, 1),
    )
    refresh = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_META), 0), lambda x: x.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b""")),
        lambda x: F.regexp_extract(x, _REFRESH, 1),
    )
    found = pages.select(F.col(url).alias("url"), F.explode(F.concat(canonical, refresh)).alias("to"))
    return found.select(node_of(F.col("url")).alias("a"), target_of(F.col("to"), F.col("url")).alias("b")).where("a != b").distinct()


def judge(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(id, host, path, rule, verdict, by) of each page; ``by`` is rule, alias or default.

    ``rules`` has action (allow, block), host and path; ``redirects`` has source and target addresses.
    """
    address = F.col(url)
    base = pages.select(F.col(id).alias("id"), host_of(address).alias("host"), path_of(address).alias("path"), node_of(address).alias("node"))
    judged = _ruled(base, rules)
    edges = links_of(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")).where("a != b"))
    edges = materialize(edges.distinct(), "aliases")
    if edges.isEmpty():  # no page has an alias
        judged = judged.withColumn("aliased", F.lit(False))
    else:
        groups = materialize(connected_components(edges), "alias_groups")
        known = judged.where(F.col("action") == "block").select("node").distinct()
        # what the links name may be no page at all; rules hold for it too
        outside = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        outside = outside.select("node", F.regexp_extract("node", "^[^/]*", 0).alias("host"), F.regexp_extract("node", "^[^/]*([^?]*)", 1).alias("path"))
        named = _ruled(outside, rules).where(F.col("action") == "block").select("node")
        blocked = groups.join(known.union(named).distinct(), "node", "left_semi").select("component").distinct()
        aliases = groups.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("aliased"))
        judged = judged.join(aliases, "node", "left").withColumn("aliased", F.coalesce("aliased", F.lit(False)))
    by_rule = F.col("action").isNotNull()
    return judged.select(
        F.col("id").alias(id),
        "host",
        "path",
        "rule",
        F.when(by_rule, F.col("action")).when(F.col("aliased"), "block").otherwise("allow").alias("verdict"),
        F.when(by_rule, "rule").when(F.col("aliased"), "alias").otherwise("default").alias("by"),
    )


_RANKED = "array<struct<size:int,allows:boolean,rule:string,action:string>>"


def _ranked(host: Column):
    def of(rule: Column) -> Column:
        shown = F.concat(host, rule["p"])
        return F.struct(F.length(shown).alias("size"), (rule["action"] == "allow").alias("allows"), shown.alias("rule"), rule["action"].alias("action"))

    return of


def _ruled(base: DataFrame, rules: DataFrame) -> DataFrame:
    """Add rule and action of the longest rule that fits; both null if none does."""
    rows = rules.where("action IN ('allow', 'block') AND host IS NOT NULL AND host != ''").select(
        "action", F.translate("host", UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p")
    )
    rows = rows.withColumn("labels", F.size(F.split("h", r"\."))).distinct()
    sizes = [(r["labels"], r["n"]) for r in rows.groupBy("labels").agg(F.count("*").alias("n")).orderBy("labels").collect()]
    out, candidates = base, []
    for labels, n in sizes:  # at most as many as a host name has labels
        own = rows.where(F.col("labels") == labels).groupBy("h").agg(F.collect_list(F.struct("p", "action")).alias(f"r{labels}"))
        own = own.withColumnRenamed("h", f"h{labels}")
        suffix = F.substring_index("host", ".", -labels)
        enough = F.size(F.split("host", r"\.")) >= labels
        out = out.join(F.broadcast(own) if n <= BROADCAST_RULES else own, enough & (suffix == F.col(f"h{labels}")), "left")
        fits = F.filter(f"r{labels}", lambda r: F.startswith(F.col("path"), r["p"]))
        candidates.append(F.coalesce(F.transform(fits, _ranked(F.col(f"h{labels}"))), F.array().cast(_RANKED)))
    if not candidates:
        return base.withColumns({"rule": F.lit(None).cast("string"), "action": F.lit(None).cast("string")})
    best = F.array_max(F.concat(*candidates))
    return out.withColumn("best", best).select(*base.columns, F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
