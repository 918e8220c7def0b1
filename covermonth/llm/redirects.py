"""URL rules, and blocks that follow redirects.

A rule names a host and the start of a path. It decides for the URLs that it fits, the longest rule
first. URLs without a rule can be other names of a blocked one: a page that redirects to it or
names it as its canonical address, or the other way round. Redirects and canonical links are the
edges of a graph of URLs; its components are classes of equivalent URLs, and a block of one URL is a
block of its class, except for those that a rule allows.

Everything here is DataFrame functions. Only pages with a link of these kinds enter the
graph, and only the blocked URLs of the classes meet the pages again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth.llm.components import components
from covermonth.llm.scratch import Scratch

MOST_RULES = 1000  # they are part of the plan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Tags end at the next < or >, so that an unclosed one costs no more than its own length.
_TAGS = r"(?i)<(?:link|meta)\s[^<>]*>"
_CANONICAL = (r"""(?i)\srel\s*=\s*("([^"]*\s)?canonical(\s[^"]*)?"|'([^']*\s)?canonical(\s[^']*)?'"""
              r"""|canonical[\s/>])""")
_REFRESH = r"""(?i)\shttp-equiv\s*=\s*["']?refresh["'\s/>]"""
_HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
_CONTENT = r"""(?i)\scontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
_URL = r"""(?i)url\s*=\s*["']?([^"']*)"""


class Rule(NamedTuple):
    """A verdict for a host, with all its subdomains, and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def with_parts(rows: DataFrame, url: str) -> DataFrame:
    """rows with host, path and query of a column of URLs.

    The host is what stands between the first :// and the next /, ? or #, A-Z in lower case; the path is what
    follows, up to ? or #; the query starts with its ?. All are empty where there is no ://.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    # Each step is a projection of its own: what is used several times is computed once.
    return rows.withColumn("rest", rest).withColumns({
        "host": F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), _UPPER, _LOWER),
        "path": F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract("rest", r"^[^?#]*(\?[^#]*)", 1)}).drop("rest")


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """verdict and name of the longest rule that fits; an allowing one among equally long ones. Null if none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    # The last one put around is asked first.
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.verdict == "allow")):
        fits = (((host == rule.host) | host.endswith("." + rule.host))
                & path.startswith(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.verdict).alias("verdict"),
                                      F.lit(str(rule)).alias("rule"))).otherwise(found)
    return found


def address() -> Column:
    """The same text for URLs that name one resource: host, path and query, without the scheme, a
    default port and the fragment; an empty path is /. Null if there is no host. From the columns of
    `with_parts`."""
    host, path, query = F.col("host"), F.col("path"), F.col("query")
    return F.when(host != "", F.concat(
        F.regexp_replace(host, r":(80|443)?$", ""), F.when(path == "", "/").otherwise(path),
        F.when(query == "?", "").otherwise(query)))


def resolved(rows: DataFrame) -> DataFrame:
    """rows (url, link) with source, the address of the page, and target, the address its link leads to.

    Links can be absolute, start at the host (//host/path), at the root, at the query, or be relative;
    the steps . and .. of their paths are followed. target is null where a link is not one of http.
    """
    link = F.col("link")
    rows = with_parts(rows, "url").withColumns({
        "source": address(),
        "link": F.trim(F.regexp_replace(F.replace(link, F.lit("&amp;"), F.lit("&")), r"[\t\r\n]", "")),
        "folder": F.regexp_extract("path", r"^(.*/)", 1)})
    root = F.concat(F.lit("http://"), "host")
    full = (
        F.when(link.rlike(r"(?i)^https?://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(F.col("host") == "", None)
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^(\?|#|$)"), F.concat(root, "path", link))
        .otherwise(F.concat(root, F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), link)))
    rows = with_parts(rows.select("source", full.alias("full")), "full")
    steps = F.split(F.regexp_replace("path", r"/(\.|\.\.)$", "/$1/"), "/")
    followed = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
        .otherwise(F.concat(done, F.array(step))))
    path = F.when(F.col("path").rlike(r"/\.{1,2}(/|$)"), F.array_join(followed, "/"))
    rows = rows.withColumn("path", F.coalesce(path, "path"))
    return rows.select("source", address().alias("target"))


def links(pages: DataFrame) -> DataFrame:
    """source and target addresses of the canonical links and redirects that pages state.

    pages has url and html. Only what stands before <body counts, and not what is commented out. A page
    may state several.
    """
    body = F.locate("<body", F.lower("html"))
    rows = pages.select("url", "html", body.alias("body"))
    head = F.when(F.col("body") > 0, F.substring(F.col("html"), F.lit(1), F.col("body")))
    head = F.regexp_replace(F.coalesce(head, "html"), r"(?s)<!--.*?-->", "")
    rows = rows.select("url", F.explode(F.regexp_extract_all(head, F.lit(_TAGS), F.lit(0))).alias("tag"))

    def value(pattern: str) -> Column:
        return F.concat(*[F.regexp_extract("tag", pattern, k) for k in (1, 2, 3)])

    link = (F.when(F.col("tag").rlike(r"(?i)^<link") & F.col("tag").rlike(_CANONICAL), value(_HREF))
            .when(F.col("tag").rlike(r"(?i)^<meta") & F.col("tag").rlike(_REFRESH),
                  F.regexp_extract(value(_CONTENT), _URL, 1)))
    return resolved(rows.select("url", F.when(link != "", link).alias("link")))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and blocked_by of every row of pages (page_id, url, html).

    The longest rule that fits decides. A URL that no rule fits is blocked if its class, the URLs
    that it is joined with by links of the pages or by rows of `redirects` (source and target URLs),
    has one that a rule blocks; blocked_by is the smallest such address. Otherwise it is allowed. A rule that allows
    a URL holds for that URL, whatever its class; it does not undo blocks of others.

    Null urls, and those without ://, have an empty host and path, and no class. Null and empty pages have no
    links. Repeated rows get the same verdict each. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "redirects")
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionAll(resolved(redirects.select(
            F.col("source").alias("url"), F.col("target").alias("link"))))
    # Written before it is filtered: a filter moved below the steps would repeat them.
    edges = scratch.save(
        edges.select(F.col("source").alias("a"), F.col("target").alias("b")), "links")
    edges = edges.where("a != b")
    judged = with_parts(pages.select("page_id", "url"), "url")
    judged = judged.select("page_id", "host", "path", address().alias("address"),
                           rule_for(F.col("host"), F.col("path"), rules).alias("ruled"))
    if edges.isEmpty():
        blocked = edges.select(F.col("a").alias("node"), F.col("b").alias("blocked_by"))
    else:
        blocked = _blocked(components(edges, scratch, "classes"), rules, scratch)
    key = F.when(F.col("ruled").isNull(), F.col("address"))
    return (judged.join(blocked, key == F.col("node"), "left").select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce(F.col("ruled.verdict"),
                   F.when(F.col("blocked_by").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"), "blocked_by"))


def _blocked(classes: DataFrame, rules: Sequence[Rule], scratch: Scratch) -> DataFrame:
    """node and blocked_by of the addresses that no rule fits, in classes with a blocked one."""
    judged = with_parts(classes.withColumn("url", F.concat(F.lit("http://"), "node")), "url")
    judged = scratch.save(judged.select(
        "node", "root", rule_for(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict")),
        "verdicts")
    least = judged.where("verdict = 'block'").groupBy("root").agg(F.min("node").alias("blocked_by"))
    return scratch.save(
        judged.where("verdict is null").join(least, "root").select("node", "blocked_by"), "blocked")
