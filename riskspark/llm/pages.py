"""Main text of web pages by consensus over the pages of a host.

Each page's containers are scored by the text they hold outside links; the best
one casts a vote for its generalised tag-class path. Votes are counted per host in
Spark, and every page of the host is read again at the winning path, widened to the
whole article: the vote says where the article is, not where it ends.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm import columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body main article section div td blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside center dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li "
    "menu nav ol p pre summary table tbody tfoot th thead title tr ul br".split())
#: A start of one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: What never belongs to the main text.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg canvas nav header footer aside form button select textarea "
    "input label menu dialog audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe signup sidebar aside widget nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination pager header masthead topbar footer copyright comment comments commentlist discussion replies respond disqus share sharing "
    "social related recommended recommendations toolbar search login form".split())
#: Below this share of the text of the page's own best place, the host's place is not the page's article.
SMALL = 1 / 3
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACES = re.compile(r"\s+")


class Page(HTMLParser):
    """Collects text blocks and the containers around them in one pass."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, container, dropped
        self.paths: list[str] = [""]
        self.parents: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self.text: list[str] = []
        self.linked = self.in_link = self.container = 0
        self.dropped = False

    def _flush(self) -> None:
        if self.text:
            if text := _SPACES.sub(" ", "".join(self.text)).strip():
                self.blocks.append((self.container, text, min(self.linked, len(text))))
            self.text = []
        self.linked = 0

    def _close(self, to: int) -> None:
        while len(self.open) > to:
            tag, self.container, self.dropped = self.open.pop()
            self.in_link -= tag == "a"

    def _last(self, tag: str) -> int | None:
        """The place of the innermost open tag, not looking out of a table cell for a cell."""
        return next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
        if tag in ENDS_PARAGRAPH and (i := self._last("p")) is not None:
            self._close(i)
        if tag == "li" and self.open and (i := self._last("li")) is not None and not any(t in ("ul", "ol") for t, _, _ in self.open[i:]):
            self._close(i)
        if tag in VOID:
            return
        if tag == "a" and (i := self._last("a")) is not None:
            self._close(i)
        attrs = {k: v or "" for k, v in attrs}
        names = attrs.get("class", "").split()
        self.open.append((tag, self.container, self.dropped))
        self.in_link += tag == "a"
        if not self.dropped and tag not in ("html", "body"):
            marks = {w.lower() for n in [*names, attrs.get("id", "")] for w in _WORDS.findall(n)}
            hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
            self.dropped = tag in DROPPED or hidden or attrs.get("role", "").lower() in ROLES or (bool(marks & MARKS) and tag not in ("article", "main"))
        if tag in CONTAINERS and not self.dropped:
            kept = sorted({x for n in names if (x := re.sub(r"\d+", "#", n.lower()))})
            self.paths.append(f"{self.paths[self.container]}/{'.'.join([tag, *kept])}")
            self.parents.append(self.container)
            self.container = len(self.paths) - 1

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        if tag not in VOID and (i := self._last(tag)) is not None:
            self._close(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if not self.dropped:
            self.text.append(data)
            if self.in_link:
                self.linked += len(data)

    @classmethod
    def read(cls, html: str | None) -> Page:
        page = cls()
        page.feed(html or "")
        page.close()
        page._flush()
        return page

    def best(self) -> tuple[str, float]:
        """The path of the container with most text of its own outside links; a child's
        text counts half. Ties: the outer, then the earlier one."""
        score = [0.0] * len(self.paths)
        for container, text, linked in self.blocks:
            value = max(len(text) - 2 * linked, 0)
            while container >= 0 and value >= 1:
                score[container] += value
                container, value = self.parents[container], value / 2
        at = max(range(len(score)), key=score.__getitem__)
        return self.paths[at], score[at]

    def _sums(self, own: list[int]) -> list[int]:
        """Of each container: the sum over it and all inside it."""
        for i in range(len(own) - 1, 0, -1):  # a parent comes before its children
            own[self.parents[i]] += own[i]
        return own

    def _region(self, path: str) -> list[int]:
        """Of each container: 2 inside the article that a container with the path belongs
        to, 1 inside the widened part of a page without articles, 0 elsewhere.

        The article is the nearest article or main element, and the main element around
        the only article. Without one, it is the outermost container that adds text
        outside links."""
        tags = [p.rpartition("/")[2].partition(".")[0] for p in self.paths]
        own = [0] * len(tags)
        for container, text, linked in self.blocks:
            own[container] += max(len(text) - 2 * linked, 0)
        held = self._sums(own)
        articles = self._sums([int(t == "article" and h > 0) for t, h in zip(tags, held)])
        inside = [0] * len(tags)
        for i in [i for i, p in enumerate(self.paths) if p == path]:
            above = [i]
            while self.parents[above[-1]] >= 0:
                above.append(self.parents[above[-1]])
            at = next((k for k in above if tags[k] in ("article", "main")), None)
            if at is None:
                at = next(k for k in above if held[k] == held[above[-1]])
                inside[at], inside[i] = max(inside[at], 1), 2
                continue
            main = next((k for k in above if k < at and tags[k] == "main"), at)
            inside[main if articles[main] == articles[at] else at] = 2
        for i in range(1, len(inside)):
            inside[i] = max(inside[i], inside[self.parents[i]])
        return inside

    def main_text(self, path: str | None) -> str:
        """The blocks of the article at the path, or at the page's own best container where
        the first holds no text or a small part of what the second holds."""
        found = []
        best = self.best()[0]
        for wanted in (path, best) if path != best else (best,):
            inside = self._region(wanted)
            kept = [(t, max(len(t) - 2 * n, 0)) for c, t, n in self.blocks if inside[c] == 2 or inside[c] and len(t) > 2 * n]
            found.append((" ".join(t for t, _ in kept), sum(v for _, v in kept)))
        (text, value), (other, most) = found[0], found[-1]
        return text if text and value >= SMALL * most else other


def with_host(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit("")).alias("host"))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes) of the path with most votes, ties to more text, then the
    smaller path. Votes are summed in the tasks, so a large host is no hot key."""

    def run(batches):
        for batch in columns.small_batches(batches, "html"):
            out = [Page.read(h).best() for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                                             names=["host", "path", "score"])

    voted = pages.select("host", "html").mapInArrow(run, "host string, path string, score double").where("score > 0")
    counted = voted.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    best = counted.groupBy("host").agg(F.min(F.struct(-F.col("votes"), -F.col("score"), "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"), (-F.col("best.col1")).alias("votes"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every row of (page_id, url, html).

    A NULL or empty html, or a page without main text, gives an empty text. Pages
    without a valid host vote together. path is the host's winning path. Repeated rows and NULL ids are kept; other
    columns are ignored."""
    pages = with_host(pages)

    def run(batches):
        for batch in columns.small_batches(batches, "html"):
            text = [Page.read(h).main_text(p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), batch.column("path")],
                names=["page_id", "url", "text", "n_chars", "path"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.join(winning_paths(pages), "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long, path string")
