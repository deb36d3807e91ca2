"""URL filters with redirect equivalence, in DataFrame functions only.

A page's url is judged by the longest fitting rule (host and its subdomains, path prefix).
Redirects (``meta http-equiv=refresh``) and canonical links (``link rel=canonical``), all of
those found in a page, are edges between urls (without fragments); their distributed connected components
are groups of aliases. A url without a rule of its own takes the decision of its group: block
if a member is blocked by a rule, unless a member is explicitly allowed, which comes first.
Other urls are allowed.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and
has no aliases. Null or empty html has no links. Rows given twice are judged alike. Pages with
one url are one node. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.support import connected_components, stage

#: (verdict, host, path) rules of the registered query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

_LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_META = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def resolved(target: Column, url: Column) -> Column:
    """A link's absolute url, without fragment: null for other schemes than those with ``://``.
    References are taken as the generic url syntax says (``?x`` keeps the page's path, ``../``
    and ``./`` go)."""
    link = F.regexp_replace(target, r"(?s)#.*", "")
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(url, r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    path, query = F.regexp_extract(link, r"(?s)^([^?]*)", 1), F.regexp_extract(link, r"(?s)^[^?]*(.*)", 1)
    path = F.when(path.startswith("/"), path).when(folder == "", F.concat(F.lit("/"), path)).otherwise(F.concat(folder, path))
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda done, part: (
        F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part)))))
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link == "", F.regexp_extract(url, r"(?s)^([^#]*)", 1))
            .when(link.startswith("?"), F.concat(page, link)).otherwise(F.concat(origin, F.lit("/"), F.array_join(kept, "/"), query)))


def targets_of(html: Column) -> Column:
    """The targets of all canonical links and refreshes of a page, ``&amp;`` decoded."""
    tags = lambda tag, target: F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: F.regexp_replace(
        F.regexp_extract(t, target, 1), r"(?i)&(?:amp|#0*38|#x0*26);", "&"))
    return F.array_distinct(F.filter(F.concat(tags(_LINK, _HREF), tags(_META, _URL)), lambda t: t != ""))


def node_of(url: Column) -> Column:
    """The number of a url's node: host in lower case, the rest as it is, no fragment."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.xxhash64(host_of(url), rest))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, html)."""
    url, html = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = stage(pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"),
                              node_of(url).alias("node"), targets_of(html).alias("targets")), "pages")
    own = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("own", own)
    links = (rows.where("node is not null and size(targets) > 0").select("node", "own", "url", F.explode("targets").alias("target"))
             .select("node", "own", resolved(F.col("target"), F.col("url")).alias("to")).where(node_of(F.col("to")).isNotNull()))
    edges = stage(links.select("node", "own", node_of(F.col("to")).alias("to"),
                               rule_of(host_of(F.col("to")), path_of(F.col("to")), rules).alias("to_own")), "links")
    members = connected_components(edges, "node", "to")
    ruled = (edges.select("node", F.col("own.verdict").alias("v")).unionAll(edges.select("to", "to_own.verdict")).where("v is not null")
             .groupBy("node").agg(F.max(F.col("v") == "allow").alias("allow"), F.max(F.col("v") == "block").alias("block")))
    groups = members.join(ruled, "node").groupBy("root").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    blocked = members.join(groups.where("block and not allow").select("root"), "root").select(F.col("node").alias("alias"))
    with_rule = rows.where("own is not null").select("page_id", "host", "path", "own.rule", "own.verdict")
    free = rows.where("own is null").join(blocked, F.col("node") == F.col("alias"), "left").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("alias").isNotNull(), "block").otherwise("allow").alias("verdict"))
    return with_rule.unionAll(free)
