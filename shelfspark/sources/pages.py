"""Captured pages: states, extraction of embedded JSON and microdata, sitemaps, scrubbing."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.pricing import coerce_price, stock_of_count, was_if_higher
from shelfspark.functions.vocabulary import (
    BRAND_CLASS, GATE_TITLE, HEADING_CLASS, MEMBERS_PHRASE, NAME_CLASS, NO_SALE_KINDS, PRICE_MAX, PRICE_MIN, PRICE_SPEC, SHELL_CHARS, TEXT_TAGS, VOID_TAGS, VOLUME_WORD, WAS_KIND,
)
from shelfspark.schema import BASE, COMPETITOR, RAW_PRODUCT
from shelfspark.sources.listing import sizes_of
from shelfspark.storage import spread


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)


def page_state(html: Column, title: Column, shell_chars: int = SHELL_CHARS) -> Column:
    """gate-shell, stale-sku or real-pdp, by size and title."""
    small = F.coalesce(F.length(html), F.lit(0)) < shell_chars  # no page is a small one
    return F.when(small & F.coalesce(F.contains(F.lower(title), F.lit(GATE_TITLE)), F.lit(False)), "gate-shell").when(small, "stale-sku").otherwise("real-pdp")


def fetch_outcome(status: Column, cleared: Column, size: Column, failed: Column, shell_chars: int = SHELL_CHARS) -> Column:
    """struct(block, reason) of a capture."""
    reason = (
        F.when(failed, F.lit("exception")).when(~cleared & (size < shell_chars), F.lit("gate_shell_not_cleared"))
        .when(~F.coalesce(status.isin(200, 304), F.lit(False)), F.concat(F.lit("http_"), F.coalesce(status.cast("string"), F.lit("None"))))
    )
    return F.struct(reason.isNotNull().alias("block"), reason.alias("reason"))


def loading_race(status: Column, extracted: Column, block: Column, reason: Column, title: Column) -> Column:
    """Was the page caught while still loading? Such a capture may be tried again; a gate may not."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return F.coalesce((status == 200) & ~extracted & ~block & (F.coalesce(reason, F.lit("")) != "gate_shell_not_cleared") & F.contains(t, F.lit("loading ")) & ~F.contains(t, F.lit(GATE_TITLE)), F.lit(False))


def sku_of_url(url: Column) -> Column:
    """The number after /item/, else the last segment of the path."""
    item = F.regexp_extract(url, r"/item/(\d+)", 1)
    return F.coalesce(F.nullif(item, F.lit("")), F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1))


def leading_number(url: Column) -> Column:
    return F.element_at(F.split(F.element_at(F.split(url, "/"), -1), "-"), 1)


def catalogue_of_url(url: Column, host: str = r"[^/]+") -> Column:
    """struct(gender, id) of a catalogue URL, or null."""
    pattern = rf"^https?://{host}/(men|women|kids)/catalog/(\d+)"
    return F.when(url.rlike(pattern), F.struct(F.regexp_extract(url, pattern, 1).alias("gender"), F.regexp_extract(url, pattern, 2).alias("id")))


# Secrets and what replaces them; patterns that find them; rotating parts of pages.
SECRETS = [
    (r"(?i)cf_clearance\s*=[^;\"\s]*", "cf_clearance=SCRUBBED"), (r"\bbot\d{9,10}:[A-Za-z0-9_\-]{30,}\b", "botSCRUBBED:SCRUBBED"),
    (r"(?i)\bAuthorization:\s*Bearer\s+[A-Za-z0-9._\-]+", "Authorization: Bearer SCRUBBED"), (r"(?i)hc-ping\.com/[0-9a-f\-]{32,36}", "hc-ping.com/SCRUBBED"),
]
SECRET_MARKS = [r"(?i)cf_clearance\s*=", r"\bbot\d{9,10}:[A-Za-z0-9_\-]{30,}\b", r"(?i)\bAuthorization:\s*Bearer\b", r"(?i)hc-ping\.com/[0-9a-f-]{32,36}"]
ROTATING = [
    (r'(<meta name="csrf-token" content=")[^"]*(")', "$1NORM$2"), (r'cf_clearance=[^;"\s]*', "cf_clearance=NORM"),
    (r"(_ga-pdp-(?:title__heading|title__brand|title__name|brand|name)_)[a-zA-Z0-9_]+", "$1NORM"), (r'("buildId":")[^"]*(")', "$1NORM$2"),
]


def scrub(html: Column) -> Column:
    for pattern, text in SECRETS:
        html = F.regexp_replace(html, pattern, text)
    return html


def has_secret(html: Column) -> Column:
    found = F.lit(False)
    for pattern in SECRET_MARKS:
        found |= html.rlike(pattern)
    return found


def stabilise(html: Column) -> Column:
    for pattern, text in ROTATING:
        html = F.regexp_replace(html, pattern, text)
    return html


def sitemap_slugs(maps: DataFrame, host: str = r"[^/<]+") -> DataFrame:
    """(slug, url) of the product addresses in sitemaps(xml): https://host/123-slug."""
    locs = maps.select(F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), 1)).alias("url"))
    pattern = rf"^https?://{host}/[0-9]+-([A-Za-z0-9\-]+)/?$"
    return locs.filter(F.col("url").rlike(pattern)).select(F.lower(F.regexp_extract("url", pattern, 1)).alias("slug"), "url")


_VARIANT = "struct<price:double,realPrice:double,currency:string,attributes:array<struct<name:string,value:string>>>"
NEXT_DATA = f"struct<props:struct<pageProps:struct<item:struct<id:string,name:string,brandName:string,count:int,purchaseType:string>,attributes:array<{_VARIANT}>>>>"


def embedded_products(pages: DataFrame) -> DataFrame:
    """Raw products of pages(url, html) with embedded JSON; no row without JSON, variant, sane price, name or brand."""
    raw = F.regexp_extract("html", r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    rows = pages.select("url", F.from_json(raw, NEXT_DATA)["props"]["pageProps"].alias("p")).select("url", F.col("p.item").alias("i"), F.try_element_at("p.attributes", F.lit(1)).alias("a"))
    current, real, i, a = coerce_price(F.col("a.price")), F.col("a.realPrice").cast("long"), F.col("i"), F.col("a")
    out = rows.select(
        sku_of_url(F.col("url")).alias("sku_id"), "url", F.trim(i["name"]).alias("name"), F.trim(i["brandName"]).alias("brand_raw"), current.alias("current_price"), was_if_higher(current, real).alias("was_price"),
        F.lit("KZT").alias("currency"), stock_of_count(i["count"], i["purchaseType"]).alias("availability"), F.coalesce(F.try_element_at(sizes_of(a["attributes"]), F.lit(1)), F.trim(i["name"])).alias("raw_volume_text"),
    )
    return out.filter("current_price IS NOT NULL AND name <> '' AND brand_raw <> ''")


class _Node:
    """An element, with what its subtree tells once it is closed. Facts of a child are folded into its parent at the child's closing tag, so
    each is looked at once, however deep or wide a page is."""

    __slots__ = ("tag", "attrs", "parent", "parts", "own", "at", "spec", "prop", "bad_kind", "money", "first_kind", "first_price", "for_members", "stocked")

    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None, at: int):
        self.tag, self.attrs, self.parent, self.at = tag, attrs, parent, at
        self.parts: list[_Node | str] = []
        self.own: list[str] = []
        self.prop = attrs.get("itemprop")
        #: Place of the nearest price specification around it, itself not included; -1 if there is none.
        self.spec = -1 if parent is None else parent.at if parent.prop == PRICE_SPEC else parent.spec
        self.bad_kind = self.for_members = self.stocked = False
        self.money = self.first_kind = self.first_price = None

    def fold(self) -> None:
        """Tell the parent what lies in this subtree; children come in the order of the page, so the first fact is kept."""
        up = self.parent
        link, meta = self.tag == "link", self.tag == "meta"
        kind = self.attrs.get("href", "") if link and self.prop == "priceType" else self.first_kind
        price = self.attrs.get("content", "").strip() if meta and self.prop == "price" else self.first_price
        money = self.attrs.get("content", "") if meta and self.prop == "priceCurrency" else self.money
        if link and self.prop == "priceType":
            up.bad_kind |= any(x in kind for x in NO_SALE_KINDS)
        # what a price specification holds says nothing of the prices around it
        up.bad_kind |= self.bad_kind and self.prop != PRICE_SPEC
        up.first_kind = kind if up.first_kind is None else up.first_kind
        up.first_price = price if up.first_price is None else up.first_price
        up.money = money if up.money is None else up.money
        up.stocked |= self.stocked or (link and self.prop == "availability")
        up.for_members |= self.tag in TEXT_TAGS and MEMBERS_PHRASE in "".join(self.own).lower()

    def text(self) -> str:
        """The text below; that of each element without the blanks around it."""
        done: list[list[str]] = [[]]
        left: list[tuple[object, bool]] = [(x, False) for x in self.parts[::-1]]
        while left:
            x, closes = left.pop()
            if isinstance(x, str):
                done[-1].append(x)
            elif closes:
                inner = "".join(done.pop()).strip()
                done[-1].append(inner)
            else:
                done.append([])
                left.append((x, True))
                left.extend((y, False) for y in x.parts[::-1])
        return "".join(done[0]).strip()


class _Page(HTMLParser):
    """A stack of open elements; unclosed ones end with their parent. nodes has all elements in the order of the page."""

    def __init__(self, html: str):
        super().__init__()
        self.nodes: list[_Node] = []
        self.root = self.top = _Node("", {}, None, -1)
        #: Where each element's subtree ends among the nodes.
        self.ends: list[int] = []
        self.feed(html)
        while self.top is not self.root:
            self._close()

    def _close(self) -> None:
        node, self.top = self.top, self.top.parent
        self.ends[node.at] = len(self.nodes)
        node.fold()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.top, len(self.nodes))
        self.nodes.append(node)
        self.ends.append(0)
        self.top.parts.append(node)
        self.top = node
        if tag in VOID_TAGS:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close()

    def handle_endtag(self, tag):
        node = self.top
        while node is not None and node.tag != tag:
            node = node.parent
        if node is None or node.parent is None:
            return
        while self.top is not node.parent:
            self._close()

    def handle_data(self, data):
        self.top.own.append(data)
        self.top.parts.append(data)


OFFERS = "url string, title string, sku string, h1_brand string, h1_name string, h1_text string, prices array<struct<value:long,currency:string>>, was_price long, href string, volume_texts array<string>, volume_label string, has_marker boolean, has_value boolean"


def _facts(html: str) -> dict:
    """What a page's markup holds, without judging it: an offer's candidate prices, strikethrough, heading, volume block."""
    page = _Page(html)
    nodes = page.nodes
    marks = [n for n in nodes if n.tag == "meta" and n.prop == "price"]
    places = [n.at for n in marks]

    def offered(offer: _Node) -> list[dict]:
        found = []
        for m in marks[bisect_right(places, offer.at) : bisect_left(places, page.ends[offer.at])]:
            value = m.attrs.get("content", "").strip()
            if value.isdigit() and m.spec <= offer.at and not m.parent.for_members and not m.parent.bad_kind:
                found.append({"value": min(int(value), 1 << 40), "currency": m.parent.money})
        return [p for p in found if PRICE_MIN <= p["value"] <= PRICE_MAX]

    offers = (n for n in nodes if n.prop == "offers" and n.stocked and n.attrs.get("itemtype", "").endswith("/Offer"))
    prices = next((found for found in map(offered, offers) if found), [])
    was = next((int(n.first_price) for n in nodes if n.prop == PRICE_SPEC and WAS_KIND in (n.first_kind or "") and (n.first_price or "").isdigit()), None)
    classed = lambda n, part: part in n.attrs.get("class", "")
    heading = next((n for n in nodes if n.tag == "h1" and classed(n, HEADING_CLASS)), None)
    spans = nodes[heading.at + 1 : page.ends[heading.at]] if heading else []
    brand, name = (next((n for n in spans if classed(n, k)), None) for k in (BRAND_CLASS, NAME_CLASS))
    label = next((n for n in nodes if n.tag == "div" and VOLUME_WORD in "".join(n.own)), None)
    texts, up = [], label.parent if label else None
    while up is not None and len(texts) < 3:
        texts.append(up.text())
        up = up.parent
    sku = next((n.attrs.get("content") for n in nodes if n.prop == "sku"), None)
    return {
        "title": next((n.text() for n in nodes if n.tag == "title"), ""), "sku": sku or None,
        "h1_brand": ((brand.attrs.get("content") or brand.text()) if brand else "").strip(), "h1_name": name.text() if name else "", "h1_text": next((n.text() for n in nodes if n.tag == "h1"), ""),
        "prices": prices, "was_price": was, "href": next((n.attrs.get("href", "") for n in nodes if n.tag == "link" and n.prop == "availability"), ""),
        "volume_texts": texts, "volume_label": "".join(label.own) if label else None, "has_marker": bool(marks), "has_value": any(m.attrs.get("content", "").strip() not in ("", "0") for m in marks),
    }


_FACTS = pa.schema([
    ("title", pa.string()), ("sku", pa.string()), ("h1_brand", pa.string()), ("h1_name", pa.string()), ("h1_text", pa.string()), ("prices", pa.list_(pa.struct([("value", pa.int64()), ("currency", pa.string())]))),
    ("was_price", pa.int64()), ("href", pa.string()), ("volume_texts", pa.list_(pa.string())), ("volume_label", pa.string()), ("has_marker", pa.bool_()), ("has_value", pa.bool_()),
])


def microdata_facts(pages: DataFrame) -> DataFrame:
    """One row of markup facts for each of pages(url, html); the only step that runs Python on rows, over Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.RecordBatch.from_pylist([_facts(h or "") for h in batch.column("html").to_pylist()], schema=_FACTS)
            yield pa.RecordBatch.from_arrays([batch.column("url"), *found.columns], names=["url", *found.schema.names])

    return spread(pages.select("url", "html")).mapInArrow(run, OFFERS)


def block_volume(texts: Column, label: Column) -> Column:
    """The volume of a page's volume block: the nearest text around the label with numbers counts, if it has one distinct number."""
    numbers = F.transform(texts, lambda t: F.array_distinct(F.regexp_extract_all(t, F.lit(r"\d+(?:[.,]\d+)?"), 0)))
    nearest = F.try_element_at(F.filter(numbers, lambda x: F.size(x) > 0), F.lit(1))
    unit = F.coalesce(F.nullif(F.regexp_extract(F.lower(label), "(мл|г|гр|oz|унц)", 1), F.lit("")), F.lit("мл"))
    return F.when(F.size(nearest) == 1, F.concat_ws(" ", nearest[0], unit))


def microdata_products(pages: DataFrame, shell_chars: int = SHELL_CHARS) -> DataFrame:
    """Raw products of pages(url, html) with microdata: the lowest sane price of the top-level offer, the strikethrough as old price."""
    from shelfspark.functions.pricing import availability_of_url

    real = pages.filter(page_state(F.col("html"), page_title(F.col("html")), shell_chars) == "real-pdp")
    facts = microdata_facts(real)
    least = F.array_min("prices")
    name = F.coalesce(F.nullif("h1_name", F.lit("")), F.nullif("h1_text", F.lit("")), F.nullif(F.trim(F.element_at(F.split("title", " — купить"), 1)), F.lit("")))
    out = facts.select(
        F.coalesce("sku", leading_number(F.col("url"))).alias("sku_id"), "url", name.alias("name"), F.col("h1_brand").alias("brand_raw"), least["value"].alias("current_price"), "was_price",
        F.upper(F.trim(F.coalesce(least["currency"], F.lit("KZT")))).alias("currency"), availability_of_url(F.col("href")).alias("availability"), block_volume(F.col("volume_texts"), F.col("volume_label")).alias("raw_volume_text"),
    )
    return out.filter("current_price IS NOT NULL AND name IS NOT NULL")


def catalogue_links(pages: DataFrame, base_url: str) -> DataFrame:
    """(url, pos) of the items that catalogue pages(url, html) list in their embedded JSON, each once at its first place."""
    kind = "struct<props:struct<pageProps:struct<items:struct<content:array<struct<id:long>>>>>>"
    raw = F.regexp_extract("html", r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    rows = pages.select(F.col("url").alias("page"), F.posexplode(F.from_json(raw, kind)["props"]["pageProps"]["items"]["content"]).alias("pos", "item")).filter("item.id IS NOT NULL")
    first = rows.groupBy(F.concat(F.lit(f"{base_url}/item/"), F.col("item.id").cast("string")).alias("url")).agg(F.min(F.struct("page", "pos")).alias("at"))
    return first.select("url", "at.page", "at.pos")


def parse_pages(pages: DataFrame, retailer: str, shell_chars: int = SHELL_CHARS) -> DataFrame:
    """Raw products by the retailer's own extraction; none for an unknown retailer."""
    if retailer == BASE:
        return embedded_products(pages)
    if retailer == COMPETITOR:
        return microdata_products(pages, shell_chars)
    return pages.sparkSession.createDataFrame([], RAW_PRODUCT)
