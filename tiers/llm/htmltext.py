"""Main text of pages by site style trees.

Each page is parsed into blocks of text, each with its path: the block elements above it with their classes and ids. The
pages of a host are merged into one tree of paths, copies of a page once. A path has two kinds of node: the contents found
there and their presentations (the inline elements in them). How much either varies over the pages, the entropy as a part
of the greatest it could have, is its importance, and the path has the greater of the two. In branches of low importance
(menus, notices and the like) the contents that repeat are removed from every page of the host, inside a declared article
as well; a content of one page only stays.
Presentation counts beforehand too: elements that declare themselves navigation, advert, form, comment and so on stay out
of the tree, and where a page declares its article, the text is what remains of that. A name does not hide what holds the
declared article or, unless it names comments, most of the page's text.

Pages are parsed twice, once for the tree and once for the text, so only hashes of blocks are moved and not their texts.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import keep

#: A path is judged from this many blocks on; below this share of the greatest entropy it goes.
LEAST_BLOCKS, LEAST_ENTROPY = 8, 0.3

# Elements by the part they play.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img".split()
)
NOISE = set(
    "head title script style noscript template nav footer aside button select option textarea iframe object svg"
    " canvas dialog menu audio video map math frameset applet".split()
)
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
WORDS = (
    "ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|banner|promo|promotion|cookie|cookies|consent|gdpr|"
    "notice|notices|notification|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|menu|nav|navbar|navigation|"
    "breadcrumb|breadcrumbs|sidebar|widget|widgets|related|recommended|recommendations|share|sharing|social|comment|comments|"
    "commentlist|disqus|reply|replies|respond|responses|footer|copyright|disclaimer|pagination|pager|masthead|topbar|toolbar|"
    "skip|skiplink|hidden|outbrain|taboola|tracking"
)
#: Words that say where or how such an element stands, not what an article is about.
ABOUT = (
    "area|bar|bars|block|blocks|body|bottom|box|boxes|btn|button|buttons|card|cards|center|col|column|container|content|"
    "form|global|grid|group|head|heading|icon|icons|inner|item|items|label|left|link|links|list|lists|main|mobile|module|"
    "outer|page|pane|panel|post|posts|primary|right|row|secondary|section|site|slot|small|space|sticky|sub|tab|tabs|text|"
    "thread|title|tool|tools|top|unit|user|view|wrap|wrapper|zone|[0-9a-z]|[0-9]+"
)
NOISY = re.compile(rf"(?:(?:{ABOUT})[-_]+)*(?:{WORDS})[0-9]*(?:[-_]+(?:{ABOUT}|{WORDS})[0-9]*)*", re.IGNORECASE)
COMMENTS = re.compile(r".*(?:comment|disqus|repl(?:y|ies)|respon[ds])", re.IGNORECASE)
HEADERS = re.compile(r"(?:page|site|main|global|top)?[-_]?header", re.IGNORECASE)
MAIN = re.compile(r"(?:main|content|article|post|entry|story)(?:[-_](?:content|body|text|main))?|articlebody", re.IGNORECASE)
#: What an element closes that was left open.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}


class Blocks(HTMLParser):
    """Collects (path, standing, text, inline tags); standing: 0 none, 1 main by its class, 2 article or main. No noise."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, int, int]] = []  # tag, hash of the path, noise, standing, named element
        self.found: list[tuple[int, int, str, str]] = []
        self.text: list[str] = []
        self.marks: list[str] = []
        self.tags: Counter[str] = Counter()  # open elements of each tag
        # Elements that a name or being a form speaks against: the one around each (-1: none), and whether it holds main or
        # article; for each block the innermost of them.
        self.around: list[int] = []
        self.holds: list[bool] = []
        self.comments: list[bool] = []
        self.within: list[int] = []

    def end_block(self) -> None:
        text, marks = " ".join("".join(self.text).split()), " ".join(self.marks)
        self.text.clear()
        self.marks.clear()
        if text:
            _, path, noise, standing, named = self.open[-1] if self.open else NOTHING
            if not noise:
                self.found.append((path, standing, text, marks))
                self.within.append(named)

    def push(self, tag: str, path: int, noise: bool, standing: int, named: int) -> None:
        self.open.append((tag, path, noise, standing, named))
        self.tags[tag] += 1

    def pop_to(self, i: int) -> None:
        self.end_block()
        self.tags.subtract(x[0] for x in self.open[i:])
        del self.open[i:]

    def name(self, named: int, comments: bool) -> int:
        self.around.append(named)
        self.holds.append(False)
        self.comments.append(comments)
        return len(self.around) - 1

    def judged(self) -> list[tuple[int, int, str, str]]:
        """The blocks outside of elements that their names speak against, but for those that hold the article or most text."""
        inside, every = [0] * len(self.around), 0
        for (_, _, text, _), named in zip(self.found, self.within, strict=True):
            every += len(text)
            while named >= 0:
                inside[named] += len(text)
                named = self.around[named]
        out = []
        for block, named in zip(self.found, self.within, strict=True):
            while named >= 0 and (self.holds[named] or not self.comments[named] and 2 * inside[named] > every):
                named = self.around[named]
            if named < 0:
                out.append(block)
        return out

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag == "hr":
            self.text.append(" ")
        if tag in VOID:
            return
        _, path, noise, standing, named = self.open[-1] if self.open else NOTHING
        plain = not attrs
        if tag in INLINE and not noise:
            self.marks.append(tag)
        if tag in INLINE and plain:
            self.push(tag, path, noise, standing, named)
            return
        get = dict(attrs).get
        names = [] if plain else [x for k in ("class", "id") for x in (get(k) or "").split()]
        bad = tag in NOISE or (
            not plain
            and (
                (get("role") or "").lower() in ROLES
                or "hidden" in dict(attrs)
                or get("aria-hidden") == "true"
                or bool(re.search(r"display\s*:\s*none", get("style") or ""))
            )
        )
        against = tag == "form" or not plain and tag not in ("html", "body") and any(NOISY.fullmatch(x) for x in names)
        if tag in INLINE:
            if (bad or against) and not noise:
                self.end_block()
            if against:
                named = self.name(named, any(COMMENTS.match(x) for x in names))
            self.push(tag, path, noise or bad, standing, named)
            return
        self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            own = self.open[i][0]
            if own == "p" or own in CLOSES.get(tag, ()):
                self.pop_to(i)
            elif own not in INLINE:
                break
        _, path, noise, standing, named = self.open[-1] if self.open else NOTHING
        if not standing and tag == "header":
            bad = True
        against = against or not standing and tag not in ("html", "body") and any(HEADERS.fullmatch(x) for x in names)
        if against:
            named = self.name(named, any(COMMENTS.match(x) for x in names))
        if tag in ("article", "main") or get("role") == "main" or get("itemprop") == "articleBody":
            # An article among comments is a comment.
            over = self.around[named] if against else named
            while standing < 2 and over >= 0 and not self.comments[over]:
                self.holds[over] = True
                over = self.around[over]
            standing = 2
        elif not standing and any(MAIN.fullmatch(x) for x in names):
            standing = 1
        step = tag + "".join("." + re.sub(r"\d+", "0", x) for x in names)
        self.push(tag, hashed(f"{path}/{step}"), noise or bad, standing, named)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in INLINE:
            self.end_block()

    def handle_endtag(self, tag):
        if not self.tags[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in INLINE and not self.open[i][2] and self.open[i][4] == (self.open[i - 1][4] if i else -1):
                    del self.open[i]
                    self.tags[tag] -= 1
                else:
                    self.pop_to(i)
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if not self.open or not self.open[-1][2]:
            self.text.append(data)


#: Above the page: no tag, path, noise, standing or named element.
NOTHING = ("", 0, False, 0, -1)


def blocks(html: str | None) -> list[tuple[int, int, str, str]]:
    parser = Blocks()
    # A tag that the end of the page cuts off is no text.
    parser.feed(re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", html or ""))
    parser.close()
    parser.end_block()
    return parser.judged()


def hashed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


HOST = "coalesce(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), '')"


def inputs(pages: DataFrame) -> DataFrame:
    cast = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*cast).select("page_id", "url", F.expr(HOST).alias("host"), "html")


def nodes(pages: DataFrame) -> DataFrame:
    """A row per block: host, and 64-bit hashes of path, content, presentation and of the texts of the whole page."""

    def run(batches):
        for batch in batches:
            hosts, values = [], []
            for host, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = blocks(html)
                page = hashed("\n".join(text for _, _, text, _ in found))
                for path, _, text, marks in found:
                    hosts.append(host)
                    values.append((path, hashed(text), hashed(marks), page))
            table = np.array(values, np.uint64).reshape(-1, 4).view(np.int64)
            columns = [pa.array(hosts, pa.string()), *(pa.array(np.ascontiguousarray(c)) for c in table.T)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "path", "content", "marks", "page"])

    return inputs(pages).select("host", "html").mapInArrow(run, "host string, path long, content long, marks long, page long")


def style_tree(found: DataFrame) -> DataFrame:
    """host, path (its hash), blocks, importance (0 to 1) of every path; pages with the same texts count once."""
    once = found.distinct().groupBy("host", "path", "content", "marks").agg(F.count("*").alias("n"))
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("content", "marks")]))
    each = once.select("host", "path", kinds.alias("node"), "n").groupBy("host", "path", "node").agg(F.sum("n").alias("n"))
    kind = each.groupBy("host", "path", "node.kind").agg(F.sum("n").alias("blocks"), F.sum(F.col("n") * F.log2("n")).alias("known"))
    greatest = F.log2("blocks")
    importance = F.when(F.col("blocks") > 1, (greatest - F.col("known") / F.col("blocks")) / greatest).otherwise(F.lit(1.0))
    return kind.groupBy("host", "path").agg(F.max("blocks").alias("blocks"), F.max(importance).alias("importance"))


def main_text(pages: DataFrame, least: float = LEAST_ENTROPY, many: int = LEAST_BLOCKS) -> DataFrame:
    """page_id, url, text, n_chars of every row: the blocks that remain, in page order, joined by a space.

    A page without text, or with NULL html, has an empty one. Pages with NULL url, or without a host, share one tree.
    White space is what Unicode calls so. Equal rows are pages of their own.

    The contents to remove are written and joined by host. Spark broadcasts them while they are small and else moves the
    pages, where adaptive execution cuts up a host with very many.
    """
    found = keep(nodes(pages), "blocks").distinct()
    low = style_tree(found).where((F.col("blocks") >= many) & (F.col("importance") < least)).select("host", "path")
    again = found.groupBy("host", "path", "content").agg(F.count("*").alias("n")).where("n > 1").join(low, ["host", "path"])
    low = keep(again.groupBy("host").agg(F.collect_set(F.expr("path ^ content")).alias("low")), "branches")

    def run(batches):
        for batch in batches:
            ids, urls, pages_, lows = batch.columns
            texts = []
            for html, gone in zip(pages_.to_pylist(), lows.to_pylist(), strict=True):
                found, gone = blocks(html), {x & (1 << 64) - 1 for x in gone or ()}
                best = max((standing for _, standing, _, _ in found), default=0)
                texts.append(" ".join(t for p, standing, t, _ in found if standing == best and not (gone and p ^ hashed(t) in gone)))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string())], ["page_id", "url", "text"])

    judged = inputs(pages).join(low, "host", "left").select("page_id", "url", "html", "low")
    return judged.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
