"""URL rules whose block decisions follow redirects and canonical links.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: the rest up to ``?``,
``#`` or the end. A rule ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's; the
longest fitting rule decides. A URL that no rule fits takes the decision of its aliases: the connected component over
redirect and canonical-link edges between URLs. There an explicit allow goes before an explicit block; without either
the URL is allowed. A URL's own rule is never overruled.

Edges are read from each page's whole html (``<link rel="canonical" href>``, ``<meta http-equiv="refresh">``) and may
be given as a table of redirects. Two URLs are the same vertex when they are equal but for the case of the host and
the fragment. Only URLs with edges take part in the graph.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and has no aliases; a null
html has no links; unknown relative targets are resolved against the page; repeated rows are judged each; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.graph import connected

# The rules of the registered query.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(own_host: Column, own_path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((own_host == name) | own_host.endswith("." + name)) & own_path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _decision(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, decision in rules.items():
        out = F.when(rule == name, F.lit(decision)).otherwise(out)
    return out


def vertex(url: Column) -> Column:
    """The URL with its host lower-cased and without fragment; null without ``://``."""
    bare = F.regexp_extract(url, r"^([^#]*)", 1)
    head = F.regexp_extract(bare, r"^(?s:.*?)://", 0)
    name = F.regexp_extract(bare, r"^(?s:.*?)://([^/?#]*)", 1)
    rest = F.substring(
        bare, F.length(head) + F.length(name) + 1, F.length(bare),
    )
    return F.when(F.length(head) > 0, F.concat(F.lower(head), F.translate(name, _UPPER, _LOWER), rest))


def absolute(target: Column, url: Column) -> Column:
    """A link target as an absolute URL."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"^((?s:.*?):)//", 1)
    site = F.regexp_extract(url, r"^((?s:.*?)://[^/?#]*)", 1)
    page = F.regexp_extract(url, r"^([^?#]*)", 1)
    folder = F.when(
        F.length(page) > F.length(site), F.regexp_extract(page, r"^((?s:.*)/)", 1),
    ).otherwise(F.concat(site, F.lit("/")))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(page, target))
        .otherwise(F.concat(folder, target))
    )


def links(pages: DataFrame) -> DataFrame:
    """``source, target``: canonical links and refresh redirects of the pages."""
    tags = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.when(
        F.col("tag").rlike(r"(?is)^<link\b.*\srel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"),
        F.regexp_extract("tag", r"(?is)\shref\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    refresh = F.when(
        F.col("tag").rlike(r"(?is)^<meta\b.*\shttp-equiv\s*=\s*[\"']?refresh\b"),
        F.regexp_extract("tag", r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*\burl\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    found = tags.select("url", F.coalesce(canonical, refresh).alias("target")).filter("target <> ''")
    return found.select(F.col("url").alias("source"), absolute(F.col("target"), F.col("url")).alias("target"))


def judge(pages: DataFrame, rules: dict[str, str] | None = None, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; ``redirects``: source, target URLs."""
    rules = RULES if rules is None else rules
    url = F.col("url")
    own = pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path")).withColumn(
        "rule", rule_for(F.col("host"), F.col("path"), rules),
    )
    edges = links(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("source", "target"))
    edges = edges.select(vertex(F.col("source")).alias("a"), vertex(F.col("target")).alias("b"))
    groups = connected(edges, "a", "b")
    # Aliases that have no page of their own count with the rule of their URL as well.
    alias = F.col("id")
    decided = groups.withColumn("decision", _decision(rule_for(host(alias), path(alias), rules), rules))
    by_root = decided.groupBy("root").agg(F.min("decision").alias("decision"))  # allow sorts before block
    inherited = groups.join(by_root.filter("decision is not null"), "root").select("id", "decision")
    return own.withColumn("_v", vertex(url)).join(inherited, F.col("_v") == F.col("id"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce(_decision(F.col("rule"), rules), "decision", F.lit("allow")).alias("verdict"),
    )


def query(spark: SparkSession, d: str) -> DataFrame:
    return judge(spark.read.parquet(f"{d}/pages.parquet"))


_TARGET = r"""regexp_replace(trim(t), '&amp;', '&', 'g')"""
_VERTEX = """CASE WHEN instr({0}, '://') > 0 THEN
    lower(substr({0}, 1, instr({0}, '://') + 2))
    || translate(regexp_extract({0}, '://([^/?#]*)', 1), '%s', '%s')
    || substr(regexp_extract({0}, '^([^#]*)', 1), instr({0}, '://') + 3 + length(regexp_extract({0}, '://([^/?#]*)', 1))) END""" % (_UPPER, _LOWER)
_RULE = """CASE
    WHEN (h = 'example.net' OR h LIKE '%.example.net') AND starts_with(p, '/en/') THEN 'example.net/en/'
    WHEN (h = 'example.com' OR h LIKE '%.example.com') AND starts_with(p, '/de/') THEN 'example.com/de/'
    WHEN (h = 'org' OR h LIKE '%.org') AND starts_with(p, '/fr/') THEN 'org/fr/'
    WHEN (h = 'net' OR h LIKE '%.net') AND starts_with(p, '/') THEN 'net/' END"""
_SPLIT = "translate(regexp_extract({0}, '://([^/?#]*)', 1), '%s', '%s') AS h, regexp_extract({0}, '://[^/?#]*([^?#]*)', 1) AS p" % (_UPPER, _LOWER)
_SIDE = "CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' END"

SQL = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages),
targets AS (
  SELECT url, CASE
    WHEN regexp_matches(tag, '(?is)^<link\\b.*\\srel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b')
    THEN regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\\b.*\\shttp-equiv\\s*=\\s*["'']?refresh\\b')
    THEN regexp_extract(tag, '(?is)\\bcontent\\s*=\\s*["'']?[^"''>]*\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) END AS t FROM tags),
resolved AS (
  SELECT url AS s, CASE
    WHEN regexp_matches({_TARGET}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {_TARGET}
    WHEN starts_with({_TARGET}, '//') THEN regexp_extract(url, '^(.*?:)//', 1) || {_TARGET}
    WHEN starts_with({_TARGET}, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || {_TARGET}
    WHEN starts_with({_TARGET}, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || {_TARGET}
    WHEN length(regexp_extract(url, '^([^?#]*)', 1)) > length(regexp_extract(url, '^(.*?://[^/?#]*)', 1))
    THEN regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^(.*/)', 1) || {_TARGET}
    ELSE regexp_extract(url, '^(.*?://[^/?#]*)', 1) || '/' || {_TARGET} END AS t
  FROM targets WHERE t <> ''),
edges AS (SELECT {_VERTEX.format('s')} AS a, {_VERTEX.format('t')} AS b FROM resolved),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS v, b AS w FROM both_ways UNION SELECT v, b FROM reach JOIN both_ways ON w = a),
aliases AS (SELECT w, {_RULE} AS rule FROM (SELECT DISTINCT w, {_SPLIT.format('w')} FROM reach)),
inherited AS (SELECT v, min({_SIDE}) AS d FROM reach JOIN aliases USING (w) GROUP BY v),
own AS (SELECT page_id, coalesce(h, '') AS host, coalesce(p, '') AS path, {_RULE} AS rule, v
  FROM (SELECT page_id, {_SPLIT.format('url')}, {_VERTEX.format('url')} AS v FROM pages))
SELECT page_id, host, path, rule, coalesce({_SIDE}, d, 'allow') AS verdict
FROM own LEFT JOIN inherited USING (v)
"""
