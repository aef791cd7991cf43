"""Landed files to rows: price panels, article pages, manifests, feeds, web pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from riskspark import constants as K, schemas
from riskspark.functions import dates, text as tx


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, dateFormat="yyyy-MM-dd")


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """Skip malformed lines, or keep them in ``_bad`` for inspection."""
    if not keep_bad:
        return spark.read.schema(schema).csv(path, header=True, mode="DROPMALFORMED")
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return spark.read.schema(wide).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")


def wide_to_long(panel: DataFrame) -> DataFrame:
    """date x ticker columns -> (ticker, date, price), missing cells dropped."""
    tickers = [c for c in panel.columns if c != "date"]
    out = panel.select(F.to_date("date").alias("date"), *[F.col(f"`{t}`") for t in tickers])
    return out.unpivot("date", [F.col(f"`{t}`") for t in tickers], "ticker", "price").filter("price IS NOT NULL")


def normalise_ohlcv(df: DataFrame, ticker: Column | None = None) -> DataFrame:
    """Lower-case names, drop the time of day, adjusted close falls back to close."""
    df = df.withColumnsRenamed({c: c.lower().replace(" ", "_") for c in df.columns})
    if ticker is not None:
        df = df.withColumn("ticker", ticker)
    adj = F.coalesce("adj_close", "close") if "adj_close" in df.columns else F.col("close")
    df = df.withColumns({"date": F.to_date("date"), "adj_close": adj})
    kept = [F.col(f.name).cast(f.dataType) for f in schemas.OHLCV.fields if f.name in df.columns]
    return df.select(*kept).dropna(subset=["adj_close"])


def read_hits(spark: SparkSession, path: str, domain: str, source: str, default_day: str) -> DataFrame:
    """Pages of search hits. A page is one JSON document with an array of hits."""
    pages = spark.read.schema(schemas.HITS).json(path)
    h = pages.select(F.explode("hits").alias("h")).select("h.*")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    title = F.coalesce(blank(F.col("title")), blank(F.col("story_title")))
    day = F.when(F.col("created_at_i") > 0, F.to_date(F.timestamp_seconds("created_at_i")))
    return h.select(F.coalesce(day, F.lit(default_day).cast("date")).alias("date"), F.lit(source).alias("source"),
                    F.lit(domain).alias("domain"), F.left(title, F.lit(400)).alias("headline"),
                    F.coalesce("url", F.lit("")).alias("url")).filter("headline IS NOT NULL")


def manifest_rows(df: DataFrame, payload: str, source: str) -> DataFrame:
    """Array-of-arrays listing (header row first) -> (source, timestamp, url)."""
    rows = df.select(source, F.posexplode(F.from_json(payload, schemas.MANIFEST)).alias("_i", "_r"))
    return rows.filter("_i > 0").select(source, F.get("_r", F.lit(1)).alias("timestamp"),
                                        F.get("_r", F.lit(2)).alias("url"))


def nearest_snapshots(snaps: DataFrame, hours: list[int]) -> DataFrame:
    """Per source, day and target hour the snapshot with the least hour distance, the
    earliest among equals. min(struct) keeps one candidate per map task and group."""
    t = snaps.select("source", F.to_date("ts").alias("day"), "ts",
                     F.explode(F.array(*[F.lit(h) for h in hours])).alias("target_hour"))
    best = F.min(F.struct(F.abs(F.hour("ts") - F.col("target_hour")).alias("gap"), "ts")).alias("b")
    return t.groupBy("source", "day", "target_hour").agg(best).select(
        "source", "day", "target_hour", F.col("b.ts").alias("ts"), F.col("b.gap").alias("hour_distance"))


def feed_entries(df: DataFrame, published: Column, updated: Column, title: Column, summary: Column,
                 link: Column, today: Column) -> DataFrame:
    """Feed items: 'title. summary' cut to 500 characters, first known date."""
    headline = F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(summary, F.lit("")))
    return df.select(F.coalesce(published, updated, today).alias("date"),
                     F.left(headline, F.lit(500)).alias("headline"), F.coalesce(link, F.lit("")).alias("url"))


ANCHOR = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
HEADING = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of a page with its inner text, by built-in regular expressions."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"),
                         F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("inner"))
    t = pages.select("page_id", "url", F.posexplode(found).alias("pos", "a"))
    return t.select("page_id", "pos", tx.absolute_url(F.col("a.href"), F.col("url")).alias("link"),
                    tx.clean_headline(tx.strip_tags(F.col("a.inner"))).alias("headline"))


def page_headings(pages: DataFrame) -> DataFrame:
    t = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(HEADING), F.lit(1)))
                     .alias("pos", "inner"))
    return t.select("page_id", "pos", F.col("url").alias("link"),
                    tx.clean_headline(tx.strip_tags(F.col("inner"))).alias("headline"))


class Selectors:
    """Tag and class selectors with descendant steps ("ul.content li"), compiled to bits.

    Each step of each selector has a bit. An element's state holds the steps that it or an
    ancestor has reached; a child reaches the next step if the bit before it is set in its
    parent's state and its own tag and classes match. All selectors of all sites move at
    once, by a shift."""

    def __init__(self, sites: dict[str, str]):
        self.start = 0
        self.steps: list[tuple[int, str, frozenset[str]]] = []
        self.last: dict[int, str] = {}
        at = 0
        for site, alternatives in sites.items():
            for selector in alternatives.split(","):
                self.start |= 1 << at
                for step in selector.split():
                    tag, *classes = step.split(".")
                    self.steps.append((1 << at, tag.lower(), frozenset(classes)))
                    at += 1
                self.last[1 << (at - 1)] = site
                at += 1
        self.known: dict[tuple[str, str], int] = {}

    def matches(self, tag: str, classes: str) -> int:
        """The steps that an element can take, by its tag and classes alone."""
        found = self.known.get((tag, classes))
        if found is None:
            own = set(classes.split())
            found = sum(bit for bit, want, need in self.steps if want in ("", "*", tag) and need <= own)
            if len(self.known) < 100_000:
                self.known[tag, classes] = found
        return found

    def move(self, state: int, tag: str, classes: str) -> tuple[int, list[str]]:
        """(state of the element, sites that one of whose selectors it completes)."""
        taken = state & self.matches(tag, classes)
        sites = dict.fromkeys(site for bit, site in self.last.items() if taken & bit)
        return state | (taken << 1), list(sites)


class _Containers(HTMLParser):
    """The first link inside each container of each site, nested containers included."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self, selectors: Selectors):
        super().__init__()
        self.selectors, self.found, self.link = selectors, [], None
        self.open: list[tuple[str, int, list[dict]]] = []  # tag, state, containers opened here
        self.waiting: list[dict] = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        state, sites = self.selectors.move(self.open[-1][1] if self.open else self.selectors.start, tag, attrs.get("class") or "")
        boxes = [{"site": s, "href": None, "text": []} for s in sites]
        self.found += boxes
        if tag not in self.VOID:
            self.open.append((tag, state, boxes))
            self.waiting += boxes
        if tag == "a" and "href" in attrs:
            if self.link is None:
                self.link = []
            for box in self.waiting:
                box["href"] = attrs["href"] or ""
            self.link += self.waiting
            self.waiting = []

    def handle_data(self, data):
        for box in self.link or ():
            box["text"].append(data.strip())

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                closed = {id(b) for _, _, boxes in self.open[i:] for b in boxes}
                if closed:
                    self.waiting = [b for b in self.waiting if id(b) not in closed]
                del self.open[i:]
                break


def container_headlines(pages: DataFrame, sites: dict[str, str]) -> DataFrame:
    """(page_id, site, pos, link, headline): the first link of each container that a site's
    selectors name, in page order, junk left out. A page is read once for all sites;
    nested containers each have a link of their own or share one."""
    def parse(batches):
        selectors = Selectors(sites)
        for pdf in batches:
            rows = []
            for pid, url, html in pdf.itertuples(index=False):
                p = _Containers(selectors)
                p.feed(html or "")
                p.close()
                places: dict[str, int] = {}
                for box in p.found:
                    pos = places[box["site"]] = places.get(box["site"], -1) + 1
                    if box["href"] is not None:
                        rows.append((pid, url, box["site"], pos, box["href"], "".join(box["text"])))
            yield pd.DataFrame(rows, columns=["page_id", "url", "site", "pos", "href", "inner"])

    raw = pages.select("page_id", "url", "html").mapInPandas(
        parse, "page_id long, url string, site string, pos int, href string, inner string")
    found = raw.select("page_id", "site", "pos", tx.absolute_url(F.col("href"), F.col("url")).alias("link"),
                       tx.clean_headline(F.col("inner")).alias("headline"))
    return found.filter(~tx.is_junk(F.col("headline")))
