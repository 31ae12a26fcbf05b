"""Main text of web pages, with site templates removed.

1. Every page is read as a tree of elements. Page furniture is known by tag, role or class (menus,
   headers and footers outside the article, sidebars, notices, adverts, forms, scripts, comments).
2. Subtrees are hashed (tag, texts and inner elements in order) and counted per host, and per section
   of it (the first folder of the path), over pages of different article text: copies of one page count
   once. A subtree found on at least ``MIN_PAGES`` such pages and ``SHARE`` of the host's or of the
   section's is a site template and is deleted.
3. What is left is the article: the text of ``article`` elements, else of ``main``, else of the body.
   Inside article and main only container blocks without prose go (no paragraph, heading, quotation or
   preformatted text in them), found on at least ``MANY`` pages, with at most ``PASSAGE`` characters and half of
   the page's text: headings, paragraphs and passages that several pages share stay, as do
   pages that are nothing but a template.

Shape: hashes are made per page and pre-aggregated, so a host with a third of all pages is no hot
task. A host or section has at most (subtrees of a page) / SHARE templates; pages are joined with the
templates of their host and section (Spark broadcasts a small table, else splits skewed hosts).

Defined cases: null and empty html give the empty text; a null URL or one without host has no
templates; unclosed elements end with their parent, unclosed comments and scripts with the page;
repeated rows each get their text; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.common import read_table, stage
from dialstat.llm.url_filter import split_url

MIN_PAGES, MANY, SHARE, PASSAGE = 5, 10, 0.3, 300

# fixed names of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math object select button canvas".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img input".split())
_CONTAINERS = frozenset("div section ul ol table details fieldset".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_FURNITURE = frozenset("nav aside form footer dialog menu head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_MARKS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo "
    "related replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


def _furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _FURNITURE or tag in _RAW or tag == "header" and not in_article:
        return True
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            words = set(re.split(r"[^a-z0-9]+", value.lower()))
            name = name.lower()
            if name == "role" and words & _ROLES or name in ("class", "id") and words & _MARKS:
                return True
    return False


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


class Page:
    """Elements (parent, tag, hash, outside an article) and text pieces (block, element, text)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hash = [-1], ["#"], [0]
        self.dropped, self.zone = [False], [0]  # zone: 0 body, 1 main, 2 article
        self.pieces: list[tuple[int, int, str]] = []
        stack, block, at, end = [0], 0, 0, len(source)
        is_open = {"#": 1}  # open elements by tag

        def text(lo, hi):
            if hi > lo and (source[lo:hi].strip()):
                s = entities.unescape(source[lo:hi])
                top = stack[-1]
                self.pieces.append((block, top, s))
                self.hash[top] = (self.hash[top] * 1000003 ^ _hash(" ".join(s.split()))) & (2**63 - 1)
            elif hi > lo:
                self.pieces.append((block, stack[-1], " "))

        def pop():
            e = stack.pop()
            is_open[self.tag[e]] -= 1
            own = (self.hash[e] * 31 + _hash(self.tag[e])) & (2**63 - 1)
            self.hash[e] = own
            up = self.parent[e]
            self.hash[up] = (self.hash[up] * 1000003 ^ own) & (2**63 - 1)

        while at < end:
            m = _TAG.search(source, at)
            if not m:
                break
            text(at, m.start())
            at, tag = m.end(), m.group(2)
            if not tag:
                continue
            tag = tag.lower()
            if tag not in _INLINE:
                block += 1
            if m.group(1):
                if is_open.get(tag):
                    while self.tag[stack[-1]] != tag:
                        pop()
                    pop()
                continue
            if tag in _VOID:
                continue
            attributes = m.group(3)
            ends = _CLOSES.get(tag)
            if ends and self.tag[stack[-1]] in ends | {"p"}:
                while len(stack) > 1 and self.tag[stack[-1]] in ends | {"p"}:
                    pop()
            elif tag not in _INLINE and self.tag[stack[-1]] == "p":
                pop()
            up = stack[-1]
            zone = 2 if tag == "article" else max(self.zone[up], 1 if tag == "main" or 'role="main"' in attributes else 0)
            drop = self.dropped[up] or _furniture(tag, attributes, zone > 0)
            if tag in _RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at) if not attributes.endswith("/") else None
                at = close.end() if close else (at if attributes.endswith("/") else end)
                continue
            if attributes.endswith("/") and tag not in _INLINE and tag not in ("p", "div", "section", "article", "main"):
                continue
            self.parent.append(up)
            self.tag.append(tag)
            self.hash.append(7)
            self.dropped.append(drop)
            self.zone.append(zone)
            is_open[tag] = is_open.get(tag, 0) + 1
            stack.append(len(self.tag) - 1)
        text(at, end)
        while len(stack) > 1:
            pop()

    def subtrees(self) -> list[int]:
        """Hashes of the elements, without the page's own frame and the elements that hold an article or main."""
        frame = {e for e in range(len(self.tag)) if self.tag[e] in ("#", "html", "body")}
        for e in range(1, len(self.tag)):
            if self.zone[e] > self.zone[self.parent[e]]:
                while e > 0 and e not in frame:
                    frame.add(e)
                    e = self.parent[e]
        return sorted({h for e, (t, h) in enumerate(zip(self.tag, self.hash)) if e not in frame and t not in _INLINE and h})

    def main_text(self, templates=frozenset(), many=frozenset()) -> str:
        """The article without ``templates``; inside article and main only containers in ``many`` go."""
        size, prose = [0] * len(self.tag), [t in _PROSE for t in self.tag]
        for _, e, s in self.pieces:
            size[e] += len(s.strip())
        for e in range(len(self.tag) - 1, 0, -1):
            if not self.dropped[e]:
                size[self.parent[e]] += size[e]
            prose[self.parent[e]] |= prose[e]
        best = max(self.zone)
        most = sum(n for n, e in zip(size, range(len(size))) if best and self.zone[e] == best and self.zone[self.parent[e]] < best)
        gone, cut, safe = [False], [False], [False]
        for e in range(1, len(self.tag)):
            up, known = self.parent[e], self.hash[e] in templates and self.tag[e] not in ("html", "body")
            inside = known and self.zone[e] > 0
            known = known and (not inside or self.zone[e] == self.zone[up] and self.hash[e] in many
                               and self.tag[e] in _CONTAINERS and not prose[e])
            safe.append(safe[up] or inside and size[e] > min(PASSAGE, most / 2))  # so are the parts of a long passage
            gone.append(gone[up] or self.dropped[e] or known and not inside)
            cut.append(cut[up] or known and inside and not safe[e])
        kept = [p for p in self.pieces if not gone[p[1]]]
        for zone in (2, 1, 0):
            for whole in (False, True):  # a text of nothing but templates stays
                blocks: dict[int, list[str]] = {}
                for block, e, s in kept:
                    if self.zone[e] >= zone and (whole or not cut[e]):
                        blocks.setdefault(block, []).append(s)
                texts = [" ".join("".join(b).split()) for b in blocks.values()]
                if any(texts):
                    return "\n".join(t for t in texts if t)
        return ""


def _decoded(html: bytes | None) -> str:
    return html.decode("utf-8", "replace") if html else ""


def section_of(path) -> F.Column:
    """The first folder of a path; empty for pages at the top of their host."""
    return F.coalesce(F.regexp_extract(path, "^/([^/]+)/", 1), F.lit(""))


def templates(pages: DataFrame, html: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE, many: int = MANY) -> DataFrame:
    """(host, section, hashes, many): the site templates of each section of a host, and of the host (section null), and
    those of them on at least ``many`` pages; ``pages`` has columns host, section and ``html``."""
    def run(batches):
        for b in batches:
            rows = []
            for host, section, source in zip(*[b.column(i).to_pylist() for i in (0, 1)], b.column(2).cast(pa.binary()).to_pylist()):
                page = Page(_decoded(source))
                body = _hash(page.main_text()) >> 1
                rows += [(host, section, h, body) for h in [0, *page.subtrees()]]
            if rows:
                yield pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], *[
                    pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3)]], names=["host", "section", "hash", "body"])

    found = pages.where("host <> ''").select("host", "section", f"`{html}`").mapInArrow(
        run, "host string, section string, hash long, body long")
    found = stage(found.distinct(), "subtrees")
    out = None
    for rows in (found.withColumn("section", F.lit(None).cast("string")).distinct(), found.where("section <> ''")):
        counts = stage(rows.groupBy("host", "section", "hash").agg(F.count(F.lit(1)).alias("n")), "subtree-counts")
        of = counts.where("hash = 0").select(F.col("host").alias("h"), F.col("section").alias("s"), F.col("n").alias("pages"))
        often = counts.where("hash <> 0").where(F.col("n") >= min_pages).join(
            of, (F.col("host") == F.col("h")) & F.col("section").eqNullSafe(F.col("s")))
        often = often.where(F.col("n") >= share * F.col("pages")).groupBy("host", "section").agg(
            F.collect_list("hash").alias("hashes"), F.collect_list(F.when(F.col("n") >= many, F.col("hash"))).alias("many"))
        out = often if out is None else out.unionAll(often)
    return out


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{url}`").cast("string").alias("url_"), F.col(f"`{html}`").alias("html"))
    host, path = split_url(F.col("url_"))
    rows = rows.withColumns({"host": host, "section": section_of(path)}).drop("url_")
    known = stage(templates(rows, "html", min_pages, share), "templates")
    of_host = known.where("section is null").select(F.col("host").alias("of"), F.col("hashes").alias("one"), F.col("many").alias("many1"))
    of_section = known.where("section is not null").select(
        F.col("host").alias("of2"), F.col("section").alias("in2"), F.col("hashes").alias("two"), F.col("many").alias("many2"))
    joined = rows.join(of_host, F.col("host") == F.col("of"), "left").join(
        of_section, (F.col("host") == F.col("of2")) & (F.col("section") == F.col("in2")), "left")
    none = F.array().cast("array<bigint>")
    both = lambda a, b: F.array_union(F.coalesce(a, none), F.coalesce(b, none))
    joined = joined.select("page_id", "url", "html", both("one", "two").alias("hashes"), both("many1", "many2").alias("many"))

    def run(batches):
        for b in batches:
            sources, hashes, often = b.column(2).cast(pa.binary()), b.column(3), b.column(4)
            step = 200
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                texts = [Page(_decoded(s)).main_text(frozenset(h or ()), frozenset(m or ())) for s, h, m in zip(
                    *[c.slice(lo, step).to_pylist() for c in (sources, hashes, often)])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()),
                     pa.array(np.array([len(t) for t in texts], np.int64))], names=["page_id", "url", "text", "n_chars"])

    schema = joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
