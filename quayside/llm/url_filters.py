"""URL filters with redirect equivalence.

Rules name a host, with all its subdomains, and the front of a path, to block or to
allow; among the rules that fit a url the longest counts. A decision also reaches
the aliases of a url: pages that redirect to it, name it as canonical, or share its
canonical form. Aliases are the connected components over these edges, found with
distributed rounds. Explicit rules take precedence over anything inherited, and
within a component an allow takes precedence over a block; without either a url is
allowed.

The canonical form of a url drops the fragment, tracking parameters (``TRACKING``)
and slashes at the end of the path. Nodes are canonical forms, so only declared
links make edges. Links are read from ``<link rel=canonical>`` and
``<meta http-equiv=refresh>`` in the page; further redirects can be given as a
table (src, dst). Only urls with a link, or a rule, take part in a shuffle besides
the final join.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: from there up to ``?``, ``#`` or the end. Null or no ``://``: both empty, no
rule, no alias, allowed. Empty tables, repeated rows and extra columns are kept as
they are; null pages have no links. Rules of equal length: the longer host, then
block, counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import connected_components
from quayside.llm.tables import cut_lineage

TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = (r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)",)
_REFRESH = (r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)",)
LINKS = _CANONICAL + _REFRESH


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    return lower_ascii(_part(url, 1))


def path_of(url: Column) -> Column:
    return _part(url, 2)


def canonical_form(url: Column) -> Column:
    """Host, path without slashes at its end, and the query without tracking parameters; null without a host."""
    kept = F.filter(F.split(F.regexp_replace(_part(url, 3), r"^\?", ""), "&"),
                    lambda p: (p != "") & ~F.split_part(p, F.lit("="), F.lit(1)).isin(*TRACKING))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))) \
        .otherwise(F.lit(""))
    return F.when(host_of(url) != "", F.concat(
        host_of(url), F.regexp_replace(path_of(url), "/+$", ""), query))


def _absolute(link: Column, url: Column) -> Column:
    """A link of a page as a url; links relative to a folder are taken from the page's folder."""
    root = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return (F.when(link == "", None).when(F.locate("://", link) > 0, link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (u, v) between canonical forms, as pages declare them."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    links = F.array(*[F.regexp_extract(html, p, 1) for p in LINKS])
    found = pages.where(html.rlike("(?i)canonical|refresh")).select(url.alias("url"), F.explode(links).alias("link"))
    return found.select(canonical_form(F.col("url")).alias("u"),
                        canonical_form(_absolute(F.col("link"), F.col("url"))).alias("v")) \
        .where("u is not null and v is not null")


def rule_table(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table; a policy is a parameter, not data."""
    return pages.sparkSession.createDataFrame(
        list(rules), "rule_host string, rule_path string, rule_verdict string")


def url_verdicts(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None,
    url_col: str = "url", html_col: str | None = "html",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (and ``inherited``: by alias).

    Columns of these names that ``pages`` has are replaced.
    """
    made = ("host", "path", "rule", "verdict", "inherited")
    url = F.col(f"`{url_col}`")
    # Distinct (host, path) pairs meet the rules at each parent of the host.
    spots = pages.select(host_of(url).alias("h"), path_of(url).alias("p")).where("h <> ''").distinct()
    labels = F.split("h", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = spots.select("h", "p", F.explode(parents).alias("rule_host")).join(rules, "rule_host") \
        .where(F.col("p").startswith(F.col("rule_path")))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"),
                    F.length("rule_host").alias("hn"), (F.col("rule_verdict") == "block").alias("b"),
                    F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("said"))
    ruled = cut_lineage(fits.groupBy("h", "p").agg(F.max(rank).alias("r"))
                        .select("h", "p", "r.rule", "r.said"))

    # The input's columns travel as one, so none of theirs can clash with ours.
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                        url.alias("_url"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = base.join(ruled.withColumnsRenamed({"h": "host", "p": "path"}), ["host", "path"], "left")

    edges = redirects.select(canonical_form(F.col("src")).alias("u"), canonical_form(F.col("dst")).alias("v")) \
        if redirects is not None else None
    if html_col is not None:
        own = page_links(pages, url_col, html_col)
        edges = own if edges is None else edges.union(own)
    form = canonical_form(F.col("_url"))
    # Urls of one canonical form are aliases without an edge: the form is their node.
    votes = judged.where("said is not null").select(form.alias("node"), "said")
    if edges is not None:
        linked = cut_lineage(connected_components(edges).withColumnRenamed("component", "class"))
        votes = votes.join(linked, "node", "left").select(F.coalesce("class", "node").alias("class"), "said")
        judged = judged.withColumn("node", form).join(linked, "node", "left") \
            .withColumn("class", F.coalesce("class", "node"))
    else:
        votes = votes.withColumnRenamed("node", "class")
        judged = judged.withColumn("class", form)
    # "allow" is the smaller of the two words: explicit allow precedence.
    heard = votes.groupBy("class").agg(F.min("said").alias("heard"))
    out = judged.join(heard, "class", "left")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in pages.columns if c not in made], "host", "path", "rule",
        F.coalesce("said", "heard", F.lit("allow")).alias("verdict"),
        (F.col("said").isNull() & F.col("heard").isNotNull()).alias("inherited"))
