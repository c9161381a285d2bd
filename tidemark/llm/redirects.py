"""URL filters with redirect equivalence.

A URL's own verdict comes from the longest host and path rule that fits. URLs without a rule take the
verdict of their aliases: spellings of one address (scheme, ``www.``, trailing slash, fragment,
tracking parameters) and everything linked by canonical links and redirects, found as connected
components over both kinds of edge. Among aliases an explicit allow wins over a block; without any
decision a URL is allowed. An explicit rule is never overruled.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule, has no
aliases and is allowed; null html has no links; rows that repeat are judged each; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, staged
from tidemark.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # host, path, verdict

# Query parameters that only tell where a visitor came from.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&#]*"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits, null without one. The list is a
    parameter of the job, not data."""
    fits = [F.when(
        ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
        F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                 F.lit(v).alias("verdict"))) for h, p, v in rules]
    return F.greatest(*fits, F.lit(None), F.lit(None)) if fits else F.lit(None).cast(
        "struct<size:int,rule:string,verdict:string>")


def address(url: Column) -> Column:
    """One spelling per address; null for a URL without a host."""
    parts = F.struct(
        F.regexp_replace(host_of(url), r"^www\.", "").alias("host"),
        F.regexp_replace(path_of(url), r"/+$", "").alias("path"),
        F.regexp_replace(F.regexp_replace(
            F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1),
            rf"(?:^|&){TRACKING}", ""), r"^&", "").alias("query"))
    return let(parts, lambda p: F.when(p["host"] != "", F.concat(
        F.lit("https://"), p["host"], p["path"],
        F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))))


def _resolve(href: Column, url: Column) -> Column:
    parts = F.struct(
        F.regexp_extract(url, r"^([^:]*):", 1).alias("scheme"), host_of(url).alias("host"),
        F.regexp_extract(path_of(url), r"^(.*/)", 1).alias("folder"))
    return let(parts, lambda p: F.when(F.instr(href, "://") > 0, href)
               .when(href.startswith("//"), F.concat(p["scheme"], F.lit(":"), href))
               .when(href.startswith("/"), F.concat(p["scheme"], F.lit("://"), p["host"], href))
               .otherwise(F.concat(p["scheme"], F.lit("://"), p["host"],
                                   F.when(p["folder"] == "", "/").otherwise(p["folder"]), href)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b, url): addresses joined by a canonical link or a refresh redirect of the page, and the
    URL that names b."""
    link = F.regexp_extract(
        "html", r"""(?is)(<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>)""", 1)
    meta = F.regexp_extract(
        "html", r"""(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>)""", 1)
    canonical = F.regexp_extract(link, r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    refresh = F.regexp_extract(meta, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)""", 1)
    targets = F.filter(F.array(canonical, refresh), lambda x: x != "")
    named = pages.select("url", F.explode(targets).alias("href")).select(
        address(F.col("url")).alias("a"), _resolve(F.col("href"), F.col("url")).alias("url"))
    return named.select("a", address(F.col("url")).alias("b"), "url").filter(
        "a is not null and b is not null").distinct()


def judge(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict, component. ``edges(a, b)`` of further redirects, as
    URLs, may be given beside those found in the pages."""
    url = F.col("url")
    found = alias_edges(pages)
    if edges is not None:
        both = edges.union(edges.select("b", "a"))
        found = found.union(both.select(
            address(F.col("a")).alias("a"), address(F.col("b")).alias("b"),
            F.col("b").alias("url")).dropna())
    found = staged(found, "alias-links")
    groups = staged(components(found.select("a", "b")), "aliases")
    judged = pages.select(
        "page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"),
        address(url).alias("node"),
    ).withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    judged = judged.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    linked = found.select(F.col("b").alias("node"), fitting_rule(
        host_of(url), path_of(url), rules)["verdict"].alias("verdict")).join(
        groups, "node", "left").select(F.coalesce("component", "node").alias("component"), "verdict")
    decided = judged.select("component", F.col("own.verdict").alias("verdict")).union(linked).filter(
        "component is not null and verdict is not null").groupBy("component").agg(
        F.min("verdict").alias("of_aliases"))  # 'allow' sorts before 'block'
    return judged.join(decided, "component", "left").select(
        "page_id", "url", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "of_aliases", F.lit("allow")).alias("verdict"), "component")


def judge_sql(rules: Sequence[Rule]) -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    return f"""
WITH RECURSIVE rules(rhost, rpath, rverdict) AS (VALUES {values}),
parts AS (
  SELECT page_id, url, html, coalesce({rest}, '') AS rest FROM pages),
split AS (
  SELECT page_id, url, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')
           AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1),
           '(?:^|&){TRACKING}', '', 'g'), '^&', '') AS query
  FROM parts),
node AS (
  SELECT *, CASE WHEN host <> '' THEN 'https://' || regexp_replace(host, '^www\\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END
    END AS node FROM split),
ruled AS (
  SELECT n.*, (SELECT max({{'size': length(rhost || rpath), 'rule': rhost || rpath,
                            'verdict': rverdict}}) FROM rules
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS own
  FROM node n),
groups AS (
  SELECT node, min(own.verdict) AS of_aliases FROM ruled
  WHERE node IS NOT NULL AND own IS NOT NULL GROUP BY node)
SELECT page_id, host, path, own.rule AS rule,
       coalesce(own.verdict, of_aliases, 'allow') AS verdict
FROM ruled LEFT JOIN groups USING (node)
"""
