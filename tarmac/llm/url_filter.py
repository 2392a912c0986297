"""URL filter with redirect equivalence.

Every url gets the verdict of the longest rule that fits its host and path. Redirects (``http-equiv``
refresh) and canonical links make urls aliases of each other; connected components over these edges carry
a block to aliases that no rule decides. A rule of the url itself always comes first, so an explicit allow
stays. Urls that nothing decides are allowed.

Urls are the same node if host, path and query agree; the fragment and the scheme do not count. Null urls
and urls without ``://`` have an empty host and path, fit no rule, are no nodes and are allowed. Repeated
rows are judged alike; extra columns are ignored; a null page has no links. Only DataFrame functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.components import components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower(F.coalesce(rest, F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_part(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def _fits(rule: Rule, host_: Column, path_: Column) -> Column:
    return ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)


def ruled(frame: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``ruling`` (null where no rule fits); the longest rule wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # later, longer rules override
        fits = _fits(rule, F.col("host"), F.col("path"))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return frame.withColumns({"rule": text, "ruling": verdict})


def _node(host_: Column, path_: Column, query_: Column) -> Column:
    return F.when(host_ != "", F.concat(host_, F.when(path_ == "", "/").otherwise(path_), query_))


def _targets(page: Column) -> Column:
    """What a page's canonical links and refresh redirects point at, as written."""
    tag = r"(?is)<(?:link|meta)\b[^>]*>"
    tags = F.regexp_extract_all(page, F.lit(f"({tag})"), F.lit(1))
    wanted = F.filter(
        tags, lambda t: t.rlike(r"(?is)\brel\s*=\s*[\"']?canonical\b") | t.rlike(r"(?is)http-equiv\s*=\s*[\"']?refresh")
    )
    return F.transform(
        wanted,
        lambda t: F.trim(
            F.coalesce(
                F.nullif(F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
                F.regexp_extract(t, r"(?is)url\s*=\s*[\"']?([^\"'\s>]+)", 1),
            )
        ),
    )


def _absolute(link: Column, host_: Column, path_: Column) -> Column:
    folder = F.regexp_extract(path_, r"(?s)^(.*/)", 1)
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), host_, link))
        .when(link.startswith("?"), F.concat(F.lit("http://"), host_, path_, link))
        .otherwise(F.concat(F.lit("http://"), host_, F.when(folder == "", "/").otherwise(folder), link))
    )


def links(pages: DataFrame) -> DataFrame:
    """``a, b``: nodes of a page and of what it names as its redirect target or canonical address."""
    # most pages have neither word, and a plain search is much cheaper than the patterns
    named = pages.where(F.lower("html").contains("canonical") | F.lower("html").contains("refresh"))
    named = named.select("host", "path", "node", F.explode(_targets(F.col("html"))).alias("link"))
    named = named.where((F.col("link") != "") & F.col("node").isNotNull())
    url = named.select("node", _absolute(F.col("link"), F.col("host"), F.col("path")).alias("target"))
    target = F.col("target")
    edges = url.select(F.col("node").alias("a"), _node(host(target), path(target), query_part(target)).alias("b"))
    return edges.where("b is not null and a <> b").distinct()


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the number of other nodes that the page is an alias of."""
    url = F.col("url").cast("string")
    parts = pages.select(
        "page_id", host(url).alias("host"), path(url).alias("path"), query_part(url).alias("query"), "html"
    )
    parts = parts.withColumn("node", _node(F.col("host"), F.col("path"), F.col("query")))
    edges = links(parts)
    joined = components(edges)  # node, component; only nodes with an alias
    # targets need not be pages: their own rule counts as well
    hosts = joined.select(
        "node",
        "component",
        F.regexp_extract("node", r"(?s)^([^/]*)", 1).alias("host"),
        F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1).alias("path"),
    )
    groups = (
        ruled(hosts, rules)
        .groupBy("component")
        .agg(F.max(F.coalesce(F.col("ruling") == "block", F.lit(False))).alias("blocked"), F.count("*").alias("nodes"))
    )
    aliases = joined.join(groups, "component").select("node", "blocked", (F.col("nodes") - 1).alias("n_aliases"))
    decided = ruled(parts.drop("html", "query"), rules).join(aliases, "node", "left")
    return decided.select(
        F.col("page_id").cast("long"),
        "host",
        "path",
        "rule",
        F.coalesce("ruling", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("n_aliases", F.lit(0)).cast("long").alias("n_aliases"),
    )
