"""Block and allow urls by host and path rules, and carry blocks over to aliases.

Two urls are aliases when one redirects to the other (refresh element) or names it as its
canonical address. Aliases of aliases count too: the classes are connected components, found
by distributed label passing (see ``components``).

A rule fits its host and all subdomains if the path starts with the rule's; the longest rule
wins (rule text; then the longer host; allow before block). A url without a rule is blocked if
its class holds a blocked url and no url that a rule allows; else it is allowed.

Defined cases: a missing url, or one without ``://``, has empty host and path, no rule and no
aliases, and is allowed; rows with the same url are judged alike; a missing or empty page has
no links; links to pages that are not in the table still connect those that link there, and
rules hold for them as well. An empty table gives an empty result. The added columns replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import components, text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_TAG = r"(?i)<(?:link|meta)\s[^>]*>"
_CANONICAL = r"(?i)\srel\s*=\s*[\"']?canonical[\"'\s/>]"
_REFRESH = r"(?i)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"
_HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?i)url\s*=\s*[\"']?([^\"'\s>]+)"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table of ``rule_host``, ``rule_path`` and ``rule_verdict``."""
    names = ("rule_host", "rule_path", "rule_verdict")
    schema = pa.schema([(n, pa.string()) for n in names])
    return runtime.local_table(spark, [dict(zip(names, r, strict=True)) for r in rules], schema)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return text.ascii_lower(F.regexp_extract(text.whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(text.whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _node(host: Column, url: Column) -> Column:
    """Name of a url as an alias: host and all behind it but the fragment; none without a host.

    Scheme and fragment do not tell pages apart, so they are left out.
    """
    rest = F.regexp_extract(text.whole(url), r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(rest == "", F.lit("/")).otherwise(rest)))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias edges ``a``, ``b`` between the names of urls: canonical links and refresh redirects.

    Targets may be absolute, without a scheme, below the host or relative to the page's folder.
    """
    host = host_of(F.col(url))
    base = pages.select(
        host.alias("host"),
        _node(host, F.col(url)).alias("a"),
        F.regexp_replace(path_of(F.col(url)), r"[^/]*$", "").alias("folder"),
        F.explode(F.expr(f"regexp_extract_all(coalesce({html}, ''), r'{_TAG}', 0)")).alias("tag"),
    ).filter(F.col("a").isNotNull())
    tag = F.col("tag")
    target = F.when(tag.rlike(_CANONICAL), F.regexp_extract(tag, _HREF, 1)).when(
        tag.rlike(_REFRESH), F.regexp_extract(tag, _TARGET, 1)
    )
    to = base.withColumn("to", F.replace(target, F.lit("&amp;"), F.lit("&"))).filter(F.col("to") != "")
    start = F.when(F.col("folder") == "", F.lit("/")).otherwise(F.col("folder"))
    absolute = (
        F.when(F.col("to").contains("://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(F.lit("http://"), F.col("host"), F.col("to")))
        .otherwise(F.concat(F.lit("http://"), F.col("host"), start, F.col("to")))
    )
    named = to.withColumn("to", absolute).select("a", _node(host_of(F.col("to")), F.col("to")).alias("b"))
    return named.filter(F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()


def decide_by_rule(urls: DataFrame, rules: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest fitting rule to distinct hosts and paths.

    A host meets rules by equality with each of its suffixes, so any number of rules is one
    equi-join; the few rows per url shrink again by a map-side maximum.
    """
    parts = F.split(F.col(host), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    spread = urls.select(host, path).distinct().withColumn("rule_host", F.explode(suffixes))
    fits = spread.join(rules, "rule_host").filter(F.startswith(F.col(path), F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = fits.groupBy(host, path).agg(
        F.max(
            F.struct(
                F.length(rule).alias("n"),
                F.length("rule_host").alias("n_host"),
                (F.col("rule_verdict") == "allow").alias("allow"),
                rule.alias("rule"),
            )
        ).alias("best")
    )
    verdict = F.when(F.col("best.allow"), F.lit("allow")).otherwise(F.lit("block"))
    found = best.select(host, path, F.col("best.rule").alias("rule"), verdict.alias("rule_verdict"))
    return urls.join(found, [host, path], "left")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to pages.

    Only urls that some link touches take part in the label passing.
    """
    spark = pages.sparkSession
    edges = runtime.store(links(pages, url, html), "links")
    classes = components.connected_components(edges, "a", "b")
    members = classes.select(
        F.col("node").alias("alias"),
        "component",
        F.regexp_extract("node", r"(?s)^([^/?]*)", 1).alias("host"),
        F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1).alias("path"),
    )
    ruled = decide_by_rule(members, rules)
    blocked = (
        ruled.groupBy("component")
        .agg(
            F.max(F.col("rule_verdict") == "block").alias("any_block"),
            F.max(F.col("rule_verdict") == "allow").alias("any_allow"),
        )
        .filter(F.col("any_block") & ~F.coalesce("any_allow", F.lit(False)))
        .select("component")
    )
    aliases = runtime.store(members.join(blocked, "component", "left_semi").select("alias"), "blocked")
    host = host_of(F.col(url))
    plain = pages.drop("host", "path", "rule", "rule_verdict", "verdict", "alias", "carried")
    kept = plain.withColumns({"host": host, "path": path_of(F.col(url))}).withColumn(
        "alias", _node(F.col("host"), F.col(url))
    )
    judged = decide_by_rule(kept, rules).join(aliases.withColumn("carried", F.lit(True)), "alias", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("carried"), F.lit("block")), F.lit("allow"))
    return judged.withColumn("verdict", verdict).drop("alias", "carried", "rule_verdict")


@CATALOG.query(
    r"""
    WITH RECURSIVE rules(rule_host, rule_path, v) AS (
      VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ),
    parts AS (
      SELECT page_id, html,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest
      FROM pages
    ),
    named AS (
      SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN rest = '' THEN '/' ELSE rest END END AS alias FROM parts
    ),
    tags AS (
      SELECT alias, host, regexp_replace(path, '[^/]*$', '') AS folder,
        unnest(regexp_extract_all(coalesce(html, ''), '(?i)<(?:link|meta)\s[^>]*>')) AS tag
      FROM named WHERE alias IS NOT NULL
    ),
    hrefs AS (
      SELECT *, replace(CASE
        WHEN regexp_matches(tag, '(?i)\srel\s*=\s*["'']?canonical["''\s/>]')
          THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
        WHEN regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]')
          THEN regexp_extract(tag, '(?i)url\s*=\s*["'']?([^"''\s>]+)', 1) END, '&amp;', '&') AS t
      FROM tags
    ),
    full_hrefs AS (
      SELECT alias, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
        WHEN starts_with(t, '/') THEN 'http://' || host || t
        ELSE 'http://' || host || CASE WHEN folder = '' THEN '/' ELSE folder END || t END AS t
      FROM hrefs WHERE t <> ''
    ),
    edges AS (
      SELECT alias AS a, translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        || CASE WHEN regexp_extract(t, '(?s)^.*?://[^/?#]*([^#]*)', 1) = '' THEN '/'
           ELSE regexp_extract(t, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS b
      FROM full_hrefs WHERE regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1) <> ''
    ),
    both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach AS (
      SELECT a AS node, a AS seen FROM both_ways
      UNION
      SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen
    ),
    places AS (
      SELECT DISTINCT host, path FROM named
      UNION SELECT regexp_extract(node, '(?s)^([^/?]*)', 1), regexp_extract(node, '(?s)^[^/?]*([^?]*)', 1) FROM reach
    ),
    ruled AS (
      SELECT p.host, p.path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(v, length(rule_host || rule_path)) AS v
      FROM places p LEFT JOIN rules
        ON ('.' || p.host) LIKE ('%.' || rule_host) AND starts_with(p.path, rule_path)
      GROUP BY p.host, p.path
    ),
    carried AS (
      SELECT r.node FROM reach r JOIN ruled u
        ON u.host = regexp_extract(seen, '(?s)^([^/?]*)', 1) AND u.path = regexp_extract(seen, '(?s)^[^/?]*([^?]*)', 1)
      GROUP BY r.node HAVING bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false)
    )
    SELECT page_id, host, path, rule,
      coalesce(v, CASE WHEN alias IN (SELECT node FROM carried) THEN 'block' ELSE 'allow' END) AS verdict
    FROM named JOIN ruled USING (host, path)
    """
)
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = text.table(spark, folder, "pages").select("page_id", "url", "html")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")
