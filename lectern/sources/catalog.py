"""Web pages and paged lists as tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lectern.functions.lineage import cut
from lectern.functions.text import canonical_url, resolve_url
from lectern.operators.relations import first_wins


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links: list[list[str]] = []
        self.next, self.at = "", None

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag in ("a", "link") and own.get("href"):
            if own.get("rel") == "next":
                self.next = own["href"]
            elif tag == "a":
                self.at = [own["href"], ""]

    def handle_data(self, data):
        if self.at:
            self.at[1] += data

    def handle_endtag(self, tag):
        if tag == "a" and self.at:
            self.links.append(self.at)
            self.at = None


def page_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, ordinal, link, title, is_next) of the pages' anchors, links resolved against the page."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, u, h in batch.itertuples(index=False):
                parser = _Links()
                parser.feed(h or "")
                rows = [(href, re.sub(r"\s+", " ", title).strip(), False) for href, title in parser.links] + ([(parser.next, "", True)] if parser.next else [])
                out += [(k, u, i, *row) for i, row in enumerate(rows)]
            yield pd.DataFrame(out, columns=["key", "url", "ordinal", "href", "title", "is_next"])

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).mapInPandas(read, f"key {kind}, url string, ordinal int, href string, title string, is_next boolean")
    return found.select(F.col("key").alias(key), "ordinal", resolve_url("url", "href").alias("link"), "title", "is_next")


def catalog(links: DataFrame, code: str = r"\d{2}\.\d{2}\.\d{2}") -> DataFrame:
    """Links as cards, one for each address in canonical form (the first wins), with the code in the title ("" if none)."""
    cards = links.where(~F.col("is_next")).withColumn("address", canonical_url("link")).withColumn("code", F.regexp_extract("title", f"({code})", 1))
    return first_wins(cards, ["address"], [cards.columns[0], "ordinal"])


CARDS = "array<struct<href:string,category:string,title:string>>"


class _Cards(HTMLParser):
    """Cards: anchors of one class, with the texts of the first elements inside them of two others, up to the end tag of the same name."""

    def __init__(self, card: str, category: str, title: str):
        super().__init__()
        self.classes, self.card_class = {category: "category", title: "title"}, card
        self.found: list[dict[str, str]] = []
        self.next, self.card, self.field = "", None, None

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        named = own.get("class", "").split()
        if tag == "link" and "next" in own.get("rel", "").split():
            self.next = own.get("href", "")
        if tag == "a" and self.card_class in named:
            self.card, self.field = {"href": own.get("href", "")}, None
        inside = next((f for c, f in self.classes.items() if c in named), None)
        if self.card is not None and inside:
            self.field = (inside, tag, [])

    def handle_data(self, data):
        if self.card is not None and self.field:
            self.field[2].append(data)

    def handle_endtag(self, tag):
        if self.card is None:
            return
        if self.field and self.field[1] == tag:
            self.card[self.field[0]] = " ".join("".join(self.field[2]).split())
            self.field = None
        if tag == "a":
            if self.card["href"]:
                self.found.append(self.card)
            self.card = None


def read_cards(pages: DataFrame, url: str, html: str, card: str = "e-card", category: str = "e-card__category", title: str = "e-card__title-inner") -> DataFrame:
    """(url, next, cards): of each page the address of its rel=next link, resolved ("" if none), and its cards in order. Of pages that repeat an address one is read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for u, h in batch.itertuples(index=False):
                parser = _Cards(card, category, title)
                parser.feed(h or "")
                out.append((u, parser.next, [{"href": c["href"], "category": c.get("category", ""), "title": c.get("title", "")} for c in parser.found]))
            yield pd.DataFrame(out, columns=["url", "next", "cards"])

    once = pages.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(F.min(html).alias("html"))
    found = once.mapInPandas(read, f"url string, next string, cards {CARDS}")
    return found.select("url", resolve_url("url", "next").alias("next"), "cards")


def page_chain(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """(catalog, url, place): the pages (url, next) that each catalog (catalog, url) reaches from its first one, in order from 0, up to a page that is missing, has no next, or has come before.

    Each round doubles what is known: pages so far lead to as many more by links over twice the distance, so a chain of any length takes a logarithm of rounds.
    """
    hop = cut(pages.where("next <> ''").select("url", F.col("next").alias("to")))
    known = cut(starts.join(pages.select("url"), "url", "left_semi").select("catalog", "url", F.lit(0).cast("long").alias("place")))
    reach, size = 1, known.count()
    while True:
        onward = known.join(hop, "url").select("catalog", F.col("to").alias("url"), (F.col("place") + reach).alias("place")).join(pages.select("url"), "url", "left_semi")
        known = cut(known.unionByName(onward.select("catalog", "url", "place")).groupBy("catalog", "url").agg(F.min("place").alias("place")))
        now = known.count()
        if now == size:
            return known
        second = hop.select(F.col("url").alias("to"), F.col("to").alias("_to"))
        hop, reach, size = cut(hop.join(second, "to").select("url", F.col("_to").alias("to"))), 2 * reach, now


def catalog_cards(pages: DataFrame, starts: DataFrame, code: str = r"\d{2}\.\d{2}\.\d{2}") -> DataFrame:
    """(catalog, source_key, name, code, direction, direction_name, category, catalog_url, catalog_page, page_number) of read_cards() along each catalog's chain.

    A code is looked for in the category; what follows it is the direction's name, or the card's where that has no title. Cards without a name are left out; of those whose addresses are the same in
    canonical form the first along the chain stays.
    """
    chain = page_chain(pages.select("url", "next"), starts)
    met = chain.join(pages, "url").select("catalog", "url", "place", F.posexplode("cards").alias("ordinal", "card"))
    at = rf"\b{code}\b"
    found = F.regexp_extract("card.category", f"({at})", 1)
    rest = F.trim(F.regexp_replace(F.col("card.category"), rf"(?s)^.*?{at}", ""))
    told = met.withColumn("code", found).withColumn("rest", F.when(found != "", rest).otherwise(""))
    told = told.withColumn("name", F.when(F.col("card.title") != "", F.col("card.title")).otherwise(F.col("rest"))).where("name <> ''")
    told = told.withColumn("catalog_url", resolve_url("url", "card.href")).withColumn("source_key", canonical_url("catalog_url"))
    best = first_wins(told, ["catalog", "source_key"], ["place", "ordinal"])
    direction = F.coalesce(F.nullif("code", F.lit("")), "name")
    return best.select(
        "catalog", "source_key", "name", "code", direction.alias("direction"), F.coalesce(F.nullif("rest", F.lit("")), "name").alias("direction_name"), F.col("card.category").alias("category"), "catalog_url",
        F.col("url").alias("catalog_page"), (F.col("place") + 1).alias("page_number"),
    )


class Offsets(DataSource):
    """A list behind an offset-paged interface. `fetch`, a class attribute, is a function (offset, limit) -> rows, or (rows, total), so that any client can be used.

    The list ends with the first page that is empty, is short, or reaches the total that the page states, be that true or not. Option `total`, if given, states it for all. The end is found when
    partitions are planned: pages at doubling distances are asked for until one is past the end, then the gap is halved. Lists with a short page in between end at one of those the search meets.
    Option `page` is the page size (100), `pages` how many pages a partition reads (1).
    """

    fetch: Callable[[int, int], list[tuple] | tuple[list[tuple], int | None]] = staticmethod(lambda offset, limit: [])
    fields = "value string"

    @classmethod
    def name(cls) -> str:
        return "offsets"

    def schema(self) -> str:
        return self.fields

    def reader(self, schema) -> DataSourceReader:
        total = self.options.get("total")
        return _OffsetReader(type(self).fetch, int(self.options.get("page", 100)), int(self.options.get("pages", 1)), None if total is None else int(total))


class _OffsetReader(DataSourceReader):
    def __init__(self, fetch, size: int, pages: int, total: int | None):
        self.fetch, self.size, self.pages, self.total = fetch, size, pages, total

    def page(self, number: int) -> tuple[list[tuple], bool]:
        """(rows, whether the list ends with this page)."""
        got = self.fetch(number * self.size, self.size)
        rows, total = got if isinstance(got, tuple) else (got, None)
        total = self.total if total is None else total
        return rows, len(rows) < self.size or (total is not None and number * self.size + len(rows) >= total)

    def last(self) -> int:
        """The number of the last page."""
        if self.page(0)[1]:
            return 0
        low, high = 0, 1  # low isn't the last one
        while not self.page(high)[1]:
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.page(middle)[1] else (middle, high)
        return high

    def partitions(self) -> list[InputPartition]:
        n = self.last() + 1
        return [InputPartition((at, min(n, at + self.pages))) for at in range(0, n, self.pages)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for number in range(*partition.value):
            yield from self.page(number)[0]
