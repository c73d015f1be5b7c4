"""URL rules whose decisions follow redirects and canonical links.

A page's own rule is the longest that fits its url.  Pages that redirect to, or name
as canonical, one another are one resource: the connected components of those links.
A page without a rule of its own is allowed if a page of its component is allowed by
a rule, else blocked if one is blocked by a rule, else allowed.  DataFrame functions
only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import lower_ascii, stored, whole
from skygauge.llm.components import connected_components

# Fixed values: (verdict, host, path) of the registered query's rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def key_of(url: Column) -> Column:
    """Host, path and query of a url: scheme and fragment do not tell resources apart."""
    query = F.regexp_extract(whole(url), r"(?s)^[^#?]*(\?[^#]*)", 1)
    return F.when(F.instr(whole(url), "://") > 0, F.concat(host_of(url), path_of(url), query))


def own_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule (struct of rule and verdict) that fits; of equal ones the first by text."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(order):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, in either quotes or none, with ``&amp;`` decoded."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.replace(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)]), F.lit("&amp;"), F.lit("&"))


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target): keys of a page's url and of its canonical link or redirect.

    Read are ``<link rel=canonical href>`` and ``<meta http-equiv=refresh content>``.
    Targets without a scheme are taken relative to the page's scheme, host or folder.
    """
    tags = F.filter(F.regexp_extract_all(whole("html"), F.lit(r"(?is)(<(?:link|meta)\s[^>]*>)"), 1), lambda t: (
        t.rlike(r"""(?is)\srel\s*=\s*["']?[^"'>]*canonical""") | t.rlike(r"""(?is)http-equiv\s*=\s*["']?refresh""")))
    found = pages.filter(F.lower(whole("html")).rlike(r"canonical|refresh")).select(
        "url", F.explode(tags).alias("tag"))
    refresh = F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)url\s*=\s*['\"]?\s*([^'\"]*)", 1)
    target = F.trim(F.when(F.col("tag").rlike(r"(?i)^<link"), _attribute(F.col("tag"), "href")).otherwise(refresh))
    scheme = F.regexp_extract("url", r"(?s)^(.*?)://", 1)
    folder = F.regexp_extract(path_of(F.col("url")), r"(?s)^(.*/)", 1)
    absolute = (F.when(F.col("target").rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
                .when(F.col("target").startswith("//"), F.concat(scheme, F.lit(":"), F.col("target")))
                .when(F.col("target").startswith("/"), F.concat(scheme, F.lit("://"), host_of(F.col("url")), F.col("target")))
                .otherwise(F.concat(scheme, F.lit("://"), host_of(F.col("url")),
                                    F.when(folder == "", "/").otherwise(folder), F.col("target"))))
    linked = found.withColumn("target", target).filter("target != ''")
    return linked.select(key_of(F.col("url")).alias("source"), key_of(absolute).alias("target")).dropna()


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``.

    ``redirects`` (source, target: urls) adds links to those in the html.  A null url
    or one without ``://`` has no host and path, fits no rule, is in no component and
    is allowed.  Repeated rows are judged alike; an empty table gives no rows.
    """
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("own", own_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "key", key_of(F.col("url")))
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.union(redirects.select(key_of(F.col("source")), key_of(F.col("target"))).dropna())
    held = stored(links.distinct(), "links")
    answer = ["page_id", "host", "path", F.col("own.rule").alias("rule")]
    if not held.rows:
        return ruled.select(*answer, F.coalesce("own.verdict", F.lit("allow")).alias("verdict"))
    parts_of = connected_components(held.table, "source", "target")
    # A link may name a resource that is no page; its own rule counts too.
    node = F.concat(F.lit("x://"), F.col("node"))
    decided = parts_of.withColumn("own", own_rule(host_of(node), path_of(node), rules)).groupBy("component").agg(
        F.max(F.col("own.verdict") == "allow").alias("allowed"), F.max(F.col("own.verdict") == "block").alias("blocked"))
    fates = parts_of.join(decided, "component").select(
        F.col("node").alias("key"),
        F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("fate"))
    return ruled.join(fates, "key", "left").select(
        *answer, F.coalesce("own.verdict", "fate", F.lit("allow")).alias("verdict"))
