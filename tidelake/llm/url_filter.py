"""URL rules whose block decisions reach aliases.

A rule names a host and the beginning of a path. Urls that a redirect or a canonical link ties together are one thing under
several names: the names form a graph, and its connected components are found on Spark. A url without a rule of its own
takes over a block of its component, unless some name in it is explicitly allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import fresh, settle, text_bytes
from tidelake.llm.components import components

ALLOW, BLOCK = "allow", "block"
#: Pages without any of these cannot name another url; the others are parsed.
MARKS = "(?i)canonical|http-equiv"


def lower_ascii(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The name of a url in the graph: scheme and host in lower case, no fragment; null without ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host(url), rest))


class _Names(HTMLParser):
    """The urls that a page's head calls its own: canonical links and refreshes. Comments and scripts hold none."""

    def __init__(self, url: str):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.raw = url, [], None

    def handle_starttag(self, tag, attrs):
        given = {}
        for name, value in attrs:
            given.setdefault(name, (value or "").strip())
        if self.raw:
            return
        if tag in ("noscript", "template", "textarea", "title"):
            self.raw = tag
        elif tag == "base" and given.get("href"):
            self.base = urljoin(self.base, given["href"])
        elif tag == "link" and "canonical" in given.get("rel", "").lower().split():
            self.found.append(given.get("href", ""))
        elif tag == "meta" and given.get("http-equiv", "").lower() == "refresh":
            _, _, target = given.get("content", "").partition(";")
            name, sign, target = target.partition("=")
            if sign and name.strip().lower() == "url":
                self.found.append(target.strip().strip("'\""))

    def handle_endtag(self, tag):
        if tag == self.raw:
            self.raw = None


def named_urls(url: str, html: str) -> list[str]:
    """Absolute urls that the page gives as its canonical name or sends the reader to, fragments dropped."""
    parser = _Names(url)
    try:
        parser.feed(html)
        parser.close()
    except (AssertionError, ValueError):  # markup declarations that the parser refuses
        pass
    out = []
    for target in parser.found:
        try:
            full = urldefrag(urljoin(parser.base, target)).url if target else ""
        except ValueError:  # such as a broken IPv6 host
            continue
        if "://" in full:
            out.append(full)
    return out


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) for every canonical link and refresh in ``pages``; only pages that may hold one are parsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (source, target) for source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for target in named_urls(source, raw.decode("utf-8", "replace"))
            ]
            yield pa.RecordBatch.from_pydict({"source": [s for s, _ in pairs], "target": [t for _, t in pairs]}, pa.schema([("source", pa.string()), ("target", pa.string())]))

    likely = pages.where(F.col(url).contains("://") & F.col(html).rlike(MARKS))
    return likely.select(F.col(url).alias("u"), text_bytes(html).alias("h")).mapInArrow(run, "source string, target string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) of ``urls`` that some rule of ``rules`` fits.

    A rule (host, path, verdict) fits its host and subdomains, if the path starts with the rule's. The longest wins, host and
    path together; of equally long ones the one with the longer host, and allow before block. Rules are met by equality: a url
    asks with each ending of its host, learns how long the paths of that host's rules are, and asks again with those
    beginnings of its path. So a host with many rules costs a url as many rows as there are lengths.
    """
    named = rules.where("host IS NOT NULL AND path IS NOT NULL").withColumn("host", lower_ascii(F.col("host")))
    wanted = named.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    lengths = wanted.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths"))
    hosts = urls.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    endings = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("ending"))
    near = endings.join(lengths.withColumnRenamed("host", "ending"), "ending").select("host", "ending", F.explode("lengths").alias("size"))
    asked = urls.select("host", "path").distinct().join(near, "host").where(F.col("size") <= F.length("path"))
    asked = asked.select("host", "path", "ending", F.expr("left(path, size)").alias("start"))
    fits = asked.join(wanted.toDF("ending", "start", "verdict"), ["ending", "start"])
    rank = F.struct(F.length("ending") + F.length("start"), F.length("ending"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("ending", "start").alias("rule"), "verdict"), rank).alias("b"))
    return best.select("host", "path", "b.rule", "b.verdict")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", html: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` without ``html``, with host, path, rule (null if none fits) and verdict of each row's url.

    The verdict is that of the url's own rule. Without one it is block if redirects and canonical links tie the url to one
    that a rule blocks and to none that a rule allows, and allow otherwise. Edges come from the pages and from
    ``redirects(source, target)``, whose ends need not be pages; rules judge such ends too. Names differ if anything but the
    fragment, or the case of scheme and host, differs. A null url, or one without ``://``, has an empty host and path, fits no
    rule, has no aliases and is allowed. Every row stays, repeated ones too; input columns named as one of those added (in
    any case) are replaced.
    """
    added = ["host", "path", "rule", "verdict"]
    kept = [c for c in pages.columns if c.lower() not in {*added, (html or "").lower()}]
    own = fresh(pages, "_host", "_path", "_node")
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host(F.col(url)).alias(own[0]), path(F.col(url)).alias(own[1]), node(F.col(url)).alias(own[2]))
    edges = page_edges(pages, url, html) if html else None
    if redirects is not None:
        given = redirects.select("source", "target")
        edges = given if edges is None else edges.union(given)
    ends = None
    if edges is not None:
        edges = settle(edges.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b")).where("a <> b").distinct(), "alias-edges")
        # Without edges there is nothing to propagate, and no round of the components need run.
        if not edges.isEmpty():
            ends = settle(components(edges), "aliases").withColumns({"host": host(F.col("node")), "path": path(F.col("node"))})
    pairs = rows.select(F.col(own[0]).alias("host"), F.col(own[1]).alias("path"))
    if ends is not None:
        pairs = pairs.union(ends.select("host", "path"))
    matched = settle(match_rules(pairs, rules), "rules")
    mine = fresh(rows, "_rule", "_verdict", "_aliases")
    out = rows.join(matched.toDF(own[0], own[1], mine[0], mine[1]), own[:2], "left")
    verdict = F.coalesce(F.col(mine[1]), F.lit(ALLOW))
    if ends is not None:
        judged = ends.join(matched, ["host", "path"], "left")
        fate = judged.groupBy("component").agg(F.min("verdict").alias("verdict")).where(F.col("verdict") == BLOCK)
        blocked = settle(judged.join(fate.select("component"), "component").where("rule IS NULL").select(F.col("node").alias(own[2]), F.lit(BLOCK).alias(mine[2])), "blocked-aliases")
        out = out.join(blocked, own[2], "left")
        verdict = F.coalesce(F.col(mine[1]), F.col(mine[2]), F.lit(ALLOW))
    return out.select(*[F.col(f"`{c}`") for c in kept], F.col(own[0]).alias("host"), F.col(own[1]).alias("path"), F.col(mine[0]).alias("rule"), verdict.alias("verdict"))
