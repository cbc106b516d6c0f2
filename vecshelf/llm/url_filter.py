"""URL filter with redirect equivalence: rules on host and path, carried over to aliases.

URLs joined by redirects or canonical links are one class, found as connected components. A URL's own
longest rule decides. A URL without a rule is blocked if an alias is blocked by rule and none is
allowed by rule: an explicit allow goes before a block that is only inherited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import small_side, text_of
from vecshelf.llm.components import components
from vecshelf.session import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str]  # ("allow" or "block", host and path such as "example.org/es/")

_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias edges (a, b) that pages declare: canonical links and meta refreshes to another URL.

    Absolute targets, `//host/path` and `/path` are understood; other relative ones are not edges.
    Pages without a url or html declare nothing.
    """
    link = F.regexp_extract(F.regexp_extract(F.col(html), _LINK, 0), _HREF, 1)
    refresh = F.regexp_extract(F.col(html), _REFRESH, 1)
    found = (
        pages.where(F.col(html).rlike("(?i)canonical|refresh"))  # a cheap look before the dear one
        .select(F.col(url).cast("string").alias("a"), F.explode(F.array(link, refresh)).alias("to"))
    )
    scheme = F.substring_index("a", "://", 1)
    target = (
        F.when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), "to"))
        .when(F.col("to").startswith("/"), F.concat(scheme, F.lit("://"), url_host(F.col("a")), "to"))
        .when(F.instr("to", "://") > 0, F.col("to"))
    )
    return found.select("a", target.alias("b")).where("a is not null and b is not null and b != ''")


def _node(url: Column) -> Column:
    """The URL without its fragment, which no server sees."""
    return F.substring_index(url, "#", 1)


def rule_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each distinct url: (url, rule, action). Both tables are read whole.

    A rule (host, path, action) fits its host and all subdomains if the path starts with its path.
    Of equally long rules an allow wins.
    """
    parts = F.split(F.col("host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    ends = (
        urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .where("host != ''")
        .select("url", "path", F.explode(suffixes).alias("suffix"))
    )
    fits = ends.join(small_side(rules, 200_000), (F.col("suffix") == F.col("rule_host")) & F.expr("startswith(path, rule_path)"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("allow"), rule.alias("rule")))
    return fits.groupBy("url").agg(best.alias("best")).select(
        "url", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("action")
    )


def rule_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    rows = [(action, rule[: rule.index("/")].lower(), rule[rule.index("/") :]) for action, rule in rules]
    return df.sparkSession.createDataFrame(rows, "action string, rule_host string, rule_path string")


def judged(
    pages: DataFrame,
    rules: DataFrame | Sequence[Rule],
    edges: DataFrame | None = None,
    id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, inherited.

    `edges` (a, b) are pairs of URLs that lead to each other: redirects, canonical links. `rules` is a
    list of (action, "host/path") or a table (action, rule_host, rule_path). A null url, or one without
    `://`, has an empty host and path, no rule and no alias, and is allowed. `inherited` says that an alias
    decided. Repeated urls and ids get equal answers; other columns are not read; empty tables of
    pages or edges give empty results or no aliases.
    """
    if not isinstance(rules, DataFrame):
        rules = rule_table(pages, rules)
    rules = durable(rules)
    pages = pages.select(F.col(id).alias("page_id"), F.col(url).cast("string").alias("url"))
    own = rule_matches(pages.where("url is not null").distinct(), rules)
    found = pages.join(own, "url", "left")
    if edges is None:
        found = found.withColumn("inherited", F.lit(None).cast("boolean"))
    else:
        links = components(edges.select(_node(F.col("a")).alias("a"), _node(F.col("b")).alias("b")))
        links = durable(links)
        known = links.select(F.col("node").alias("url"), "component").join(
            rule_matches(links.select(F.col("node").alias("url")), rules), "url"
        )
        bad = known.groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed")).where("not allowed")
        blocked = links.join(bad, "component", "left_semi").select("node", F.lit(True).alias("inherited"))
        found = found.join(blocked, _node(F.col("url")) == F.col("node"), "left")
    inherited = F.col("action").isNull() & F.coalesce("inherited", F.lit(False))
    return found.select(
        "page_id", url_host(text_of("url")).alias("host"), url_path(text_of("url")).alias("path"), "rule",
        F.coalesce("action", F.when(inherited, "block").otherwise("allow")).alias("verdict"),
        inherited.alias("inherited"),
    )
