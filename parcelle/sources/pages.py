"""Listing pages -> listing rows (S12, H1-H7, E11) over a table of pages
``(page_id, url, html)``.

A table of rules says which elements matter; one pass over a page's tag stream
keeps a stack of open elements (names and numbers only, no tree, no recursion) and
notes, for each element that a rule hits, its number, where its descendants end and
its stretch of the page's text.  Cards and fields are then chosen by rank and order.
Only this pass runs in Python (``mapInArrow``, shipped by value); links, numbers,
types, labels, flags, caps and joins are DataFrame operations.

Script, style and template text is not page text.  An end tag without its start is
ignored; elements left open end with the one around them.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.operators.reports import limit_per_group


class Rule(NamedTuple):
    field: str
    rank: int                       # lower ranks win
    tags: tuple = ()                # any tag if empty
    attr: str = ""                  # an attribute that must be there ...
    words: tuple = ()               # ... and hold one of these ...
    fold: bool = True               # ... in lower case
    whole: bool = False             # ... as its whole value

    def hits(self, tag: str, attrs: dict) -> bool:
        if self.tags and tag not in self.tags or self.attr and self.attr not in attrs:
            return False
        if not self.words:
            return True
        value = attrs[self.attr].lower() if self.fold else attrs[self.attr]
        return value in self.words if self.whole else any(w in value for w in self.words)


# Which elements hold what, in order of preference.
RULES = [
    Rule("card", 0, ("div",), "class", ("search-list-item",), fold=False),
    Rule("card", 1, ("div",), "class", ("item-listing",), fold=False),
    Rule("card", 2, ("div",), "class", ("annonce",)),
    Rule("card", 3, ("div",), "class", ("ad-card",)),
    Rule("listing_link", 0, ("a",), "href", ("/annonces/",), fold=False),      # its parent is a card of rank 4
    Rule("link", 0, ("a",), "href"),
    Rule("titre", 0, ("h2", "h3", "a"), "class", ("title",)),
    Rule("titre", 1, ("h2", "h3")),
    Rule("price_text", 0, (), "class", ("price",)),
    Rule("price_text", 1, (), "class", ("prix",)),
    Rule("fact", 0, (), "class", ("detail", "tag", "item")),
    Rule("localisation", 0, (), "class", ("location", "city", "lieu")),
    Rule("description", 0, (), "class", ("description",)),
    Rule("description", 1, ("div",), "itemprop", ("description",), fold=False, whole=True),
    Rule("dpe_text", 0, (), "class", ("dpe",)),
    Rule("photo", 0, ("img",), "class", ("photo",)),
    Rule("photo", 1, ("img",), "data-src"),
]
AREA_WORDS, ROOM_WORDS = ("m²", "m2"), ("pièce", "piece")
TYPE_KEYWORDS = [("appartement", "Appartement"), ("maison", "Maison"), ("terrain", "Terrain"),
                 ("studio", "Appartement")]
AMENITIES = {"parking": ["parking", "garage"], "balcon": ["balcon"], "terrasse": ["terrasse"], "cave": ["cave"],
             "ascenseur": ["ascenseur"]}
DESCRIPTION_MAX = 2000
# Rules that an element without attributes can meet.
BARE_RULES = [rule for rule in RULES if not rule.attr]
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
# Elements that set the parser to another way of reading.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
#: Start tags kept with what the rules say of them, and their greatest length.
KEPT_TAGS, KEPT_LENGTH = 20_000, 200
#: Pages, and characters of their text, that go back to Spark at once.
BATCH_PAGES, BATCH_CHARS = 1_000, 4_000_000

CARD = "card_index:int,href:string,titre:string,price_text:string,surface_text:string,pieces_text:string,localisation:string"
SCHEMA = (f"page_id long, url string, cards array<struct<{CARD}>>, description string, dpe_text string, nb_photos int, page_text string")


class Hit(NamedTuple):
    number: int      # of the element, by its start tag
    text: int        # pieces of text before it
    value: str       # its link


class Scanner(HTMLParser):
    """The pass over one page.  Start tags written alike mean the same, so ``kept`` (shared
    by the pages of a task, bounded) spares reading and matching them again."""

    def __init__(self, kept: dict | None = None):
        super().__init__(convert_charrefs=True)
        self.kept: dict[str, tuple] = {} if kept is None else kept
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, int] = defaultdict(int)
        self.starts = self.silent = 0
        self.ends: dict[int, tuple[int, int]] = {}           # element -> (elements, pieces) when it ended
        self.text: list[str] = []
        self.found: dict[tuple[str, int], list[Hit]] = defaultdict(list)

    def updatepos(self, i, j):           # nobody asks for line numbers
        return j

    def parse_starttag(self, i):
        end = self.check_for_whole_start_tag(i)
        known = self.kept.get(self.rawdata[i:end]) if 0 <= end <= i + KEPT_LENGTH else None
        if known is None:
            return super().parse_starttag(i)
        self.begin(*known)
        return end

    def handle_starttag(self, tag, attrs):
        known = self.matched(tag, attrs)
        text = self.get_starttag_text()
        if tag not in RAW and len(text) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_TAGS:
                self.kept.clear()
            self.kept[text] = known
        self.begin(*known)

    def matched(self, tag: str, attrs: list) -> tuple:
        values = {k: v or "" for k, v in attrs}
        hits = [(rule.field, rule.rank) for rule in (RULES if values else BARE_RULES) if rule.hits(tag, values)]
        return tag, values.get("href", ""), hits

    def begin(self, tag: str, href: str, hits: list) -> None:
        for key in hits:
            self.found[key].append(Hit(self.starts, len(self.text), href))
            if key[0] == "listing_link" and self.stack:
                self.found["card", 4].append(Hit(self.stack[-1][1], 0, ""))
        if tag in VOID:
            self.ends[self.starts] = (self.starts + 1, len(self.text))
        else:
            self.stack.append((tag, self.starts))
            self.open[tag] += 1
            self.silent += tag in SILENT
        self.starts += 1

    def handle_startendtag(self, tag, attrs):
        self.begin(*self.matched(tag, attrs))
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        name = None
        while name != tag:
            name, number = self.stack.pop()
            self.open[name] -= 1
            self.silent -= name in SILENT
            self.ends[number] = (self.starts, len(self.text))

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)

    def finish(self, html: str) -> Scanner:
        try:
            self.feed(html)
            self.close()
        except AssertionError:        # a declaration the parser rejects ends the page there
            pass
        for _, number in self.stack:
            self.ends[number] = (self.starts, len(self.text))
        return self

    def said(self, hit: Hit) -> str:
        return "".join(t.strip() for t in self.text[hit.text:self.ends[hit.number][1]])

    def inside(self, field: str, rank: int, lo: int, hi: int) -> list[Hit]:
        hits = self.found.get((field, rank), [])
        return hits[bisect_right(hits, lo, key=lambda h: h.number):bisect_left(hits, hi, key=lambda h: h.number)]

    def first(self, field: str, lo: int = -1, hi: int = sys.maxsize) -> Hit | None:
        """The first element of the lowest rank among the descendants (lo, hi)."""
        return next((h[0] for rank in range(2) if (h := self.inside(field, rank, lo, hi))), None)

    def first_text(self, field: str, lo: int = -1, hi: int = sys.maxsize) -> str | None:
        hit = self.first(field, lo, hi)
        return None if hit is None else self.said(hit)

    def cards(self) -> list[dict]:
        rank = next((r for r in range(5) if self.found.get(("card", r))), None)
        out = []
        for i, card in enumerate(self.found["card", rank] if rank is not None else ()):
            span = (card.number, self.ends[card.number][0])
            facts: dict[str, str] = {}
            for hit in reversed(self.inside("fact", 0, *span)):          # the last one that says it counts
                text = self.said(hit).lower()
                kind = "surface_text" if any(w in text for w in AREA_WORDS) else "pieces_text" if any(w in text for w in ROOM_WORDS) else None
                number = text.split("m")[0] if kind == "surface_text" else text
                if kind and kind not in facts and any(c in "0123456789" for c in number):
                    facts[kind] = text
                if len(facts) == 2:
                    break
            link = self.first("link", *span)
            out.append({"card_index": i, "href": link.value if link else None, "surface_text": facts.get("surface_text"),
                        "pieces_text": facts.get("pieces_text"), **{f: self.first_text(f, *span) for f in ("titre", "price_text", "localisation")}})
        return out

    def row(self) -> dict:
        description, dpe = self.first_text("description"), self.first_text("dpe_text")
        return {"cards": self.cards(), "description": description and description[:DESCRIPTION_MAX] if description is not None else None,
                "dpe_text": dpe, "nb_photos": len(self.found.get(("photo", 0)) or self.found.get(("photo", 1)) or ()), "page_text": "".join(self.text)}


def _scan(batches):
    import pyarrow as pa
    fields = [tuple(f.split(":")) for f in CARD.split(",")]
    card = pa.struct([(n, pa.int32() if t == "int" else pa.string()) for n, t in fields])
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("cards", pa.list_(card)), ("description", pa.string()),
                        ("dpe_text", pa.string()), ("nb_photos", pa.int32()), ("page_text", pa.string())])
    kept: dict[str, tuple] = {}
    rows, chars = [], 0
    for b in batches:
        for i in range(b.num_rows):                                       # one page at a time
            html = b.column(2)[i].as_py() or ""
            rows.append({"page_id": b.column(0)[i].as_py(), "url": b.column(1)[i].as_py(), **Scanner(kept).finish(html).row()})
            chars += len(html)
            if len(rows) >= BATCH_PAGES or chars >= BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, chars = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def scan_pages(pages: DataFrame) -> DataFrame:
    """One row a page with the raw text of its cards and details."""
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_scan, SCHEMA)


def _digits(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))


def property_type(title: Column) -> Column:
    """H3: first keyword found in the lower-cased title, in the stated order."""
    t, expr = F.lower(title), F
    for kw, label in TYPE_KEYWORDS:
        expr = expr.when(t.contains(kw), F.lit(label))
    return expr


def canonical_url(url: Column) -> Column:
    """Without fragment and closing slash; the host in lower case."""
    plain = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "/+$", "")
    host = F.regexp_extract(plain, "^[A-Za-z]+://[^/?]*", 0)
    return F.concat(F.lower(host), F.substring(plain, F.length(host) + 1, F.length(plain)))


def cards_of(scanned: DataFrame) -> DataFrame:
    """H1-H4: one row per card that has a price or a title."""
    c = scanned.select("page_id", F.col("url").alias("page_url"), F.inline("cards"))
    base = F.regexp_extract(F.coalesce("page_url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    href = F.col("href")
    url = F.when(href.startswith("/"), F.concat(base, href)).when(href.startswith("http"), href).otherwise(F.concat(base, F.lit("/"), href))
    surface = F.nullif(F.regexp_replace(F.substring_index(F.col("surface_text"), "m", 1), r"[^0-9.]", ""), F.lit("")).try_cast("double")
    out = c.select("page_id", "page_url", "card_index", url.alias("url"), "titre", _digits(F.col("price_text")).try_cast("long").alias("prix_affiche"),
                   surface.alias("surface_habitable"), _digits(F.col("pieces_text")).try_cast("int").alias("nb_pieces"), "localisation",
                   property_type(F.coalesce(F.col("titre"), F.lit(""))).alias("type_bien"))
    return out.where(F.col("prix_affiche").isNotNull() | F.col("titre").isNotNull())


def details_of(scanned: DataFrame) -> DataFrame:
    """H5/H6: description (cut), energy class (first standalone A-G letter of the
    label), photo count, amenity flags from the page's text."""
    text = F.lower("page_text")
    flags = []
    for name, words in AMENITIES.items():
        cond = F.lit(False)
        for w in words:
            cond = cond | text.contains(w)
        flags.append(cond.alias(name))
    dpe = F.nullif(F.regexp_extract(F.upper("dpe_text"), r"\b([A-G])\b", 1), F.lit(""))
    return scanned.select("page_id", "url", "description", dpe.alias("dpe_classe"), "nb_photos", *flags)


def listing_cards(pages: DataFrame) -> DataFrame:
    return cards_of(scan_pages(pages)).drop("page_url")


def page_details(pages: DataFrame) -> DataFrame:
    return details_of(scan_pages(pages))


def merge_cards_details(cards: DataFrame, details: DataFrame) -> DataFrame:
    """H7: card fields plus the details of the page at the card's URL; a URL that
    several pages claim gives its details once, from the page with the least id."""
    d = limit_per_group(details.withColumn("_durl", canonical_url(F.col("url"))).where("_durl IS NOT NULL"), "_durl", 1, ["page_id"])
    d = d.drop("page_id", "url")
    # a column of its own: a sort by the bare expression computes it again for every comparison
    keyed = cards.withColumn("_curl", canonical_url(F.col("url")))
    return keyed.join(d, F.col("_curl") == F.col("_durl"), "left").drop("_curl", "_durl")


# Parts of a search page's address.
SEARCH = r"/annonce/vente-([a-z]+)-([^/?#]+)(?:\?(?:.*&)?page=([0-9]+))?"


def search_listings(cards: DataFrame, max_per_search: int) -> DataFrame:
    """The first ``max_per_search`` listings of every search over all its
    result pages, each URL once (its first place), tagged with the search.

    Cards come with ``page_url``; cards of pages that are no search are left out.
    Both limits are ranks cut before the shuffle, so no search is held whole."""
    part = [F.regexp_extract("page_url", SEARCH, i) for i in (1, 2, 3)]
    tagged = cards.withColumns({"property_type_search": part[0], "city_search": part[1],
                                "page": F.coalesce(F.nullif(part[2], F.lit("")).try_cast("long"), F.lit(1)), "_url": canonical_url(F.col("url"))})
    tagged = tagged.where("city_search <> ''")
    search, place = ["property_type_search", "city_search"], ["page", "page_id", "card_index"]
    key = F.coalesce("_url", F.concat_ws("/", F.lit("no url"), "page_id", "card_index"))      # a card without a link is one of its own
    once = limit_per_group(tagged.withColumn("_key", key), [*search, "_key"], 1, place)
    return limit_per_group(once, search, max_per_search, place).drop("_url", "_key")


# Functions of this module travel with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
