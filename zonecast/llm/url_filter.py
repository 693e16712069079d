"""URL filters over redirect equivalence: a blocked address takes its aliases along.

Addresses are aliases where one redirects to the other, names the other as its canonical link, or
differs from it only by what servers redirect away (scheme, default port, www., m., tracking
parameters, fragment, closing slash). Components of that graph are found in star rounds, and every
component gets one decision: allow where a member is explicitly allowed, else block where a member is
explicitly blocked, else allow. A rule that fits an address itself comes before its component's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import staged, unused
from zonecast.llm.near_duplicates import components
from zonecast.session import small

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*+)([^?#]*+)(?:\?([^#]*+))?"
# Rules become one literal expression, so their number is bounded; a longer list is an error.
MOST_RULES = 2_000
# What servers answer with a redirect to the plain address.
SAME_HOST = r"^(?:www|m)\.(?=[^.]++\.)"
DEFAULT_PORT = r":(?:80|443)$"
CLOSING = r"(?:/index\.html?|/)$"
TRACKING = r"^(?:utm_[a-z]++|ref|fbclid|gclid)(?:=|$)"
TAG = r"(?i)<(?:link|meta)\b[^<>]*+>"
CANONICAL = r"""(?i)\brel\s*+=\s*+["']?canonical\b"""
REFRESH = r"""(?i)\bhttp-equiv\s*+=\s*+["']?refresh\b"""
HREF = r"""(?i)\bhref\s*+=\s*+["']?([^"'\s<>]++)"""
GOES_TO = r"""(?i)\burl\s*+=\s*+["']?([^"'\s<>]++)"""


class Rule(NamedTuple):
    """``verdict`` for the host and all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null where none does. Of two as long, allow."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(
                F.lit(len(r.host + r.path)).alias("length"), F.lit(r.verdict == ALLOW).alias("allowed"),
                F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    if not fitting:
        return F.lit(None).cast("struct<length:int,allowed:boolean,rule:string,verdict:string>")
    return F.array_max(F.array_compact(F.array(*fitting)))


def plain_address(url: Column) -> Column:
    """The address that redirects of form lead to, without its scheme; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), DEFAULT_PORT, ""), SAME_HOST, "")
    path = F.regexp_replace(path_of(url), CLOSING, "")
    kept = F.filter(
        F.split(F.regexp_extract(url, PARTS, 3), "&"), lambda part: (F.length(part) > 0) & ~part.rlike(TRACKING)
    )
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.length(host) > 0, F.concat(host, path, query))


def _absolute(link: Column, url: Column) -> Column:
    """A link as the page at ``url`` means it."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*+)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]++$", "")
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path_of(url), link))
        .when(~link.startswith("#"), F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def link_targets(url: Column, html: Column) -> Column:
    """Addresses that a page names as canonical or sends its readers to, as an array."""
    tags = F.regexp_extract_all(html, F.lit(TAG), F.lit(0))
    links = F.transform(
        tags,
        lambda tag: F.when(tag.rlike(CANONICAL), F.regexp_extract(tag, HREF, 1)).when(
            tag.rlike(REFRESH), F.regexp_extract(tag, GOES_TO, 1)
        ),
    )
    links = F.filter(links, lambda link: F.coalesce(F.length(link), F.lit(0)) > 0)
    return F.transform(links, lambda link: _absolute(F.replace(link, F.lit("&amp;"), F.lit("&")), url))


def _node(url: Column) -> Column:
    return F.md5(plain_address(url).cast("binary"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rule`` is the longest rule that fits (``host/path``, null where none does) and decides; else
    the decision of the page's component does, in which the addresses that links lead to count even if
    no page has them. ``redirects`` may hold more edges, in columns ``source`` and ``target`` (any
    length of chains, loops allowed). A null url, or one without
    ``://``, has empty host and path, no aliases and is allowed. Null html has no links. Repeated
    rows and ids are judged alike; columns of these four names are replaced, all others kept. An
    empty table gives no rows. Long texts cost time in proportion to their length.

    Only nodes with edges take part in the rounds, and only their decisions meet the pages again;
    a node that many pages share costs one row per task before the shuffle.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit one expression")
    address = F.col(f"`{url}`")
    node, best, mark = unused(pages, "_node"), unused(pages, "_best"), unused(pages, "_blocked")
    judged = pages.withColumns({"host": host_of(address), "path": path_of(address), node: _node(address)})
    judged = judged.withColumn(best, best_rule(F.col("host"), F.col("path"), rules))

    edges = []  # (source, target), addresses as they are written
    if html is not None:
        named = pages.select(address.alias("url"), F.col(f"`{html}`").alias("html")).where(
            F.col("html").rlike(CANONICAL) | F.col("html").rlike(REFRESH)
        )
        edges.append(named.select(F.col("url").alias("source"), F.explode(link_targets(F.col("url"), F.col("html"))).alias("target")))
    if redirects is not None:
        edges.append(redirects.select("source", "target"))
    rated = judged.select(F.col(node).alias("node"), F.col(best)["allowed"].alias("allowed"))
    labels = None
    if edges:
        links = reduce(DataFrame.unionByName, edges).select("source", "target", _node(F.col("source")).alias("a"), _node(F.col("target")).alias("b"))
        links = staged(links.where("a is not null and b is not null"), "url-links")
        labels = components(links.select("a", "b"))
        ends = links.select(F.col("a").alias("node"), F.col("source").alias("end")).unionByName(
            links.select(F.col("b").alias("node"), F.col("target").alias("end"))
        )
        rated = rated.unionByName(
            ends.select("node", best_rule(host_of(F.col("end")), path_of(F.col("end")), rules)["allowed"].alias("allowed"))
        )
    decided = rated.where("allowed is not null and node is not null").groupBy("node").agg(F.bool_or("allowed").alias("allowed"))
    if labels is not None:
        known = staged(decided, "url-decisions")
        by_label = known.join(labels, "node").groupBy("label").agg(F.bool_or("allowed").alias("allowed"))
        members = labels.join(by_label, "label").select("node", "allowed")
        decided = known.join(labels, "node", "left_anti").unionByName(members)
    # Only blocked nodes change a page's verdict.
    blocked = small(decided.where(~F.col("allowed")).select("node"), "url-blocked")
    blocked = blocked.select(F.col("node").alias(node), F.lit(True).alias(mark))
    own = F.col(best)["verdict"]
    return judged.join(blocked, node, "left").withColumns(
        {
            "rule": F.col(best)["rule"],
            "verdict": F.coalesce(own, F.when(F.col(mark), BLOCK), F.lit(ALLOW)),
        }
    ).drop(node, best, mark)
