"""Queries on listing pages (S12, H1-H7, E11) rendered from the listings.

The given ``pages`` are ordinary web pages without listings.  Here the listings are
rendered as search and detail pages of a listing site, with the gaps, old and new
class names, odd links, deep markup and script text such pages have, so the
extraction's rows are known from the listings table and SQL can state them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.plans.catalog import register
from parcelle.plans.oracle import with_adapter
from parcelle.plans.pipelines import listings_from_pages
from parcelle.sources import pages as PG
from parcelle.sources import tables as T

SITE = "https://annonces.example"
PER_SEARCH = 15
TYPES = ["appartement", "maison", "studio"]
# The containers that sites have used for a card; the last page kind has none.
CONTAINERS = ['<div class="search-list-item">', '<div class="x item-listing">', '<div class="Annonce-box">', '<div class="AD-CARD">', "<section>"]
SCRIPT = '<script>var parking="<div class=\'price\'>1</div>";</script><style>.cave{}</style>'


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _if(cond: Column, *parts) -> Column:
    return F.when(cond, _text(*parts)).otherwise(F.lit(""))


def search_pages(spark, sf: str) -> DataFrame:
    """Result pages of searches by type and zone, listings of 1,000 ids a page; one
    listing in eleven shows up on the next page as well."""
    x = T.listings(spark, sf)
    k = F.col("id")
    kind = F.get(F.array(*map(F.lit, TYPES)), (k % 3).cast("int"))
    price = F.floor("prix_affiche").cast("long")
    href = F.when(k % 3 == 0, _text("/annonces/", k.cast("string"))).when(k % 3 == 1, _text(SITE.replace("annonces", "ANNONCES") + "/annonces/", k.cast("string"), "/")).otherwise(
        _text("annonces/", k.cast("string"), "#top"))
    group = F.floor(k / 1000) % 5
    container = F.get(F.array(*map(F.lit, CONTAINERS)), group.cast("int"))
    deep = k % 50 == 1
    link = _text('<a href="', href, '">voir</a>')
    card = _text(
        container, _if(group == 4, link), _if(deep, "<p>" * 400),
        _if(k % 7 != 0, F.when(k % 2 == 0, F.lit('<h2 class="Item-Title">')).otherwise(F.lit("<h3>")), " ", F.initcap(kind), " r&eacute;f ", k.cast("string"),
            F.when(k % 2 == 0, F.lit(" </h2>")).otherwise(F.lit("</h3>"))),
        _if(k % 5 != 0, '<span class="', F.when(k % 2 == 0, F.lit("item-price")).otherwise(F.lit("prix-total")), '">', F.floor(price / 1000).cast("string"),
            "&nbsp;<b>", F.lpad((price % 1000).cast("string"), 3, "0"), "</b> €</span>"),
        F.coalesce(_text('<ul><li class="item-tag">', F.col("surface_habitable").cast("decimal(12,2)").cast("string"), " m²</li>"), F.lit("<ul>")),
        _if((k % 4 != 0) & F.col("nb_pieces").isNotNull(), '<li class="tags">', F.col("nb_pieces").cast("string"), " pi&egrave;ces</li>"), "</ul>",
        _if(k % 6 != 0, '<p class="', F.when(k % 2 == 0, F.lit("City")).otherwise(F.lit("lieu")), '">Commune ', F.col("commune_id").cast("string"), "</p>"),
        _if(group != 4, link), _if(deep, "</p>" * 400), F.when(group == 4, F.lit("</section>")).otherwise(F.lit("</div>")))
    block = F.floor(k / 1000).cast("long")
    shown = x.select("id", kind.alias("kind"), (F.coalesce(F.col("commune_id"), F.lit(0)) % 2).alias("zone"), card.alias("card"),
                     F.explode(F.when(k % 11 == 0, F.array(block, block + 5)).otherwise(F.array(block))).alias("block"))
    # at most some 1,100 cards a page, by the ids
    page = shown.groupBy("kind", "zone", "block").agg(F.sort_array(F.collect_list(F.struct("id", "card"))).alias("c"))
    address = _text(SITE + "/annonce/vente-", F.col("kind"), "-zone-", F.col("zone").cast("string"), "?tri=date&page=", F.col("block").cast("string"))
    html = _text("<!DOCTYPE html><html><head>", SCRIPT, "</head><body></div>", F.concat_ws("\n<br>", F.col("c.card")), "</body></html>")
    return page.select((F.col("block") * 6 + F.array_position(F.array(*map(F.lit, TYPES)), F.col("kind")) * 2 - 2 + F.col("zone")).cast("long").alias("page_id"),
                       address.alias("url"), html.alias("html"))


def detail_pages(spark, sf: str) -> DataFrame:
    """A page for every second listing; one in nine comes twice, the later one empty."""
    # dealt out while a row is an id only: a few row groups of a file must not be all the tasks that read pages
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = T.listings(spark, sf).where("id % 2 = 0").select("id").repartition(parts, "id")
    k = F.col("id")
    letter = F.get(F.array(*map(F.lit, "ABCDEFG")), (k % 7).cast("int"))
    words = _text(_if(k % 10 == 0, " avec Parking"), _if(k % 12 == 0, ", garage ferm&eacute;"), _if(k % 14 == 0, ", balcon"), _if(k % 16 == 0, ", TERRASSE"),
                  _if(k % 18 == 0, ", cave"), _if(k % 22 == 0, ", ascenseur"))
    html = _text("<html>", SCRIPT, '<body><div class="', F.when(k % 3 == 0, F.lit('x" itemprop="description')).otherwise(F.lit("item-Description")), '"> Bien ', k.cast("string"),
                 _if(k % 20 == 0, "<i> ", "mot " * 700, "</i>"), "</div><p>Vue", words, ".</p>",
                 _if(k % 8 != 0, '<span class="bloc-dpe"> Classe : <b>', letter, "</b></span>"),
                 F.repeat(F.when(k % 4 == 0, F.lit('<img class="photo" src="a.jpg">')).otherwise(F.lit('<img data-src="b.jpg"/>')), (k % 5).cast("int")), "</body></html>")
    first = x.select(k.alias("page_id"), F.col("id"), html.alias("html"))
    again = first.where("id % 9 = 0").select((k + F.lit(10 ** 12)).alias("page_id"), "id", F.lit("<html></html>").alias("html"))
    return first.unionByName(again).select("page_id", _text(SITE + "/annonces/", F.col("id").cast("string")).alias("url"), "html")


SQL_CARDS = """
, shown AS (
  SELECT *, id // 1000 AS block FROM listings UNION ALL SELECT *, id // 1000 + 5 FROM listings WHERE id % 11 = 0
), kinds AS (
  SELECT *, CAST(id % 3 AS INTEGER) AS kind, coalesce(commune_id, 0) % 2 AS zone, (id // 1000) % 5 AS box FROM shown
), carded AS (
  -- without a container class only links that name the folder lead to a card
  SELECT *, block * 6 + kind * 2 + zone AS page_id, row_number() OVER (PARTITION BY kind, zone, block ORDER BY id) - 1 AS card_index
  FROM kinds WHERE box <> 4 OR id % 3 <> 2
), cards AS (
  SELECT page_id, card_index, id, block, kind, zone, CASE id % 3 WHEN 0 THEN 'https://annonces.example/annonces/' || id
           WHEN 1 THEN 'https://ANNONCES.example/annonces/' || id || '/' ELSE 'https://annonces.example/annonces/' || id || '#top' END AS url,
         CASE WHEN id % 7 <> 0 THEN (['Appartement', 'Maison', 'Studio'])[kind + 1] || ' réf ' || id END AS titre,
         CASE WHEN id % 5 <> 0 THEN CAST(floor(prix_affiche) AS BIGINT) END AS prix_affiche,
         surface_habitable, CASE WHEN id % 4 <> 0 THEN nb_pieces END AS nb_pieces,
         CASE WHEN id % 6 <> 0 THEN 'Commune ' || commune_id END AS localisation,
         CASE WHEN id % 7 <> 0 THEN (['Appartement', 'Maison', 'Appartement'])[kind + 1] END AS type_bien FROM carded
), kept AS (SELECT * FROM cards WHERE prix_affiche IS NOT NULL OR titre IS NOT NULL)"""
SQL_DETAILS = """
, detail AS (
  SELECT id, CAST(id AS BIGINT) AS page_id, 'https://annonces.example/annonces/' || id AS url,
    left('Bien ' || id || CASE WHEN id % 20 = 0 THEN rtrim(repeat('mot ', 700)) ELSE '' END, 2000) AS description,
    CASE WHEN id % 8 <> 0 THEN substr('ABCDEFG', CAST(id % 7 AS INTEGER) + 1, 1) END AS dpe_classe, CAST(id % 5 AS INTEGER) AS nb_photos,
    id % 10 = 0 OR id % 12 = 0 AS parking, id % 14 = 0 AS balcon, id % 16 = 0 AS terrasse, id % 18 = 0 AS cave, id % 22 = 0 AS ascenseur
  FROM listings WHERE id % 2 = 0
)"""


def _with(*ctes: str, body: str) -> str:
    return with_adapter("".join(ctes) + body).replace("\n, shown AS", ",\nshown AS").replace(")\n, detail AS", "),\ndetail AS") if ctes[0] is SQL_CARDS else \
        with_adapter("".join(ctes) + body).replace("\n, detail AS", ",\ndetail AS")


@register("page_cards", "S12 H1 H2 H3 H4", _with(SQL_CARDS, body="""
SELECT page_id, CAST(card_index AS INTEGER) AS card_index, url, titre, prix_affiche, surface_habitable, nb_pieces, localisation, type_bien FROM kept
"""))
def q_page_cards(spark, sf):
    return PG.listing_cards(search_pages(spark, sf))


@register("page_details", "H5 H6 §2.16", _with(SQL_DETAILS, body="""
SELECT * EXCLUDE (id) FROM detail
UNION ALL SELECT id + 1000000000000, url, NULL, NULL, 0, false, false, false, false, false FROM detail WHERE id % 9 = 0
"""))
def q_page_details(spark, sf):
    return PG.page_details(detail_pages(spark, sf))


@register("page_extract", "H1 H2 H3 H4 H5 H6 H7 P14", _with(SQL_CARDS, SQL_DETAILS, body="""
SELECT k.page_id, CAST(k.card_index AS INTEGER) AS card_index, k.url, k.prix_affiche, d.description, d.dpe_classe, d.nb_photos, d.parking, d.balcon, d.terrasse, d.cave,
       d.ascenseur FROM kept k LEFT JOIN detail d ON d.id = k.id
"""))
def q_page_extract(spark, sf):
    out = PG.merge_cards_details(PG.listing_cards(search_pages(spark, sf)), PG.page_details(detail_pages(spark, sf)))
    return out.select("page_id", "card_index", "url", "prix_affiche", "description", "dpe_classe", "nb_photos", *PG.AMENITIES)


@register("listings_by_search", "E11 W2 H7 P14 P35", _with(SQL_CARDS, SQL_DETAILS, body=f"""
, once AS (
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY kind, zone, id ORDER BY block, page_id, card_index) = 1
), capped AS (
  SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY kind, zone ORDER BY block, page_id, card_index) <= {PER_SEARCH}
)
SELECT (['appartement', 'maison', 'studio'])[c.kind + 1] AS property_type_search, 'zone-' || c.zone AS city_search, c.page_id, CAST(c.card_index AS INTEGER) AS card_index,
       c.url, c.titre, c.prix_affiche, d.dpe_classe, d.parking FROM capped c LEFT JOIN detail d ON d.id = c.id
"""))
def q_listings_by_search(spark, sf):
    out = listings_from_pages(search_pages(spark, sf), detail_pages(spark, sf), PER_SEARCH)
    return out.select("property_type_search", "city_search", "page_id", "card_index", "url", "titre", "prix_affiche", "dpe_classe", "parking")


@register("page_amenities", "H6 S12", """
SELECT page_id, contains(t, 'parking') OR contains(t, 'garage') AS parking, contains(t, 'balcon') AS balcon, contains(t, 'terrasse') AS terrasse,
       contains(t, 'cave') AS cave, contains(t, 'ascenseur') AS ascenseur
FROM (SELECT page_id, lower(regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>|<!--.*?-->', '', 'gs'), '<[^>]*>', '', 'g')) AS t FROM pages)
UNION ALL
SELECT -1 - id, id % 10 = 0 OR id % 12 = 0, id % 14 = 0, id % 16 = 0, id % 18 = 0, id % 22 = 0 FROM (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0)
""")
def q_page_amenities(spark, sf):
    """The flags on the given pages and on the rendered ones."""
    ours = detail_pages(spark, sf).where(F.col("page_id") < 10 ** 12).withColumn("page_id", -1 - F.col("page_id"))
    pages = T.read(spark, sf, "pages").select("page_id", "url", "html").unionByName(ours)
    return PG.page_details(pages).select("page_id", *PG.AMENITIES)
