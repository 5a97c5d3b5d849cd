"""Hand-made listing pages: full card, price only, title only, neither,
relative and absolute links, energy label and amenities."""

from parcelle.sources import pages as PG

PAGE = """<html><body>
<div class="search-list-item"><a href="/annonces/1"><h2 class="item-title">Appartement 3 pièces</h2></a>
  <span class="item-price">250 000 €</span><ul><li class="item-tag">65 m²</li><li class="item-tag">3 pièces</li></ul>
  <p class="item-location">Lyon 3e</p></div>
<div class="search-list-item"><a href="https://x.example/annonces/2">voir</a><span class="price">99 000</span></div>
<div class="search-list-item"><a href="annonces/3"><h3>Studio lumineux</h3></a></div>
<div class="search-list-item"><a href="/annonces/4">rien</a></div>
</body></html>"""

DETAIL = """<html><body><div class="item-description">Belle maison avec terrasse et garage.</div>
<div class="energy-dpe">Classe énergie : C</div><img class="photo" src="a.jpg"><img class="photo" src="b.jpg">
</body></html>"""


def test_cards_and_details(spark):
    pages = spark.createDataFrame([(1, "https://x.example/search?p=1", PAGE), (2, "https://x.example/annonces/1", DETAIL)],
                                  "page_id long, url string, html string")
    cards = {r.card_index: r for r in PG.listing_cards(pages).collect()}
    assert sorted(cards) == [0, 1, 2]
    full = cards[0]
    assert full.url == "https://x.example/annonces/1"
    assert full.prix_affiche == 250000 and full.surface_habitable == 65.0 and full.nb_pieces == 3
    assert full.type_bien == "Appartement" and full.localisation == "Lyon 3e"
    assert cards[1].prix_affiche == 99000 and cards[1].titre is None and cards[1].url == "https://x.example/annonces/2"
    assert cards[2].titre == "Studio lumineux" and cards[2].type_bien == "Appartement"
    assert cards[2].url == "https://x.example/annonces/3"
    det = {r.page_id: r for r in PG.page_details(pages).collect()}[2]
    assert det.dpe_classe == "C" and det.nb_photos == 2
    assert det.parking and det.terrasse and not det.balcon
    merged = PG.merge_cards_details(PG.listing_cards(pages), PG.page_details(pages)).where("card_index = 0").first()
    assert merged.dpe_classe == "C"


def scan(html):
    return PG.Scanner().finish(html).row()


def test_deep_and_broken_markup():
    deep = "<p>" * 3000 + '<div class="ad-card"><h2>Maison</h2></div>' + "</p>" * 3000
    assert [c["titre"] for c in scan(deep)["cards"]] == ["Maison"]
    row = scan("</b><div class='ad-card'><h2 class=title>Un<br> &amp; <i>deux</h2> <b class=prix>5</div><h2>dehors</h2><![x[ bad")
    assert row["cards"][0]["titre"] == "Un&deux" and row["cards"][0]["price_text"] == "5"
    assert scan("")["cards"] == [] and scan("")["description"] is None and scan("<!-- <div class=price>1 -->")["page_text"] == ""


def test_script_text_is_no_page_text():
    row = scan("<script>var parking='<b class=dpe>A</b>'</script><style>.cave{}</style><template>balcon</template><p>rien</p>")
    assert row["page_text"] == "rien" and row["dpe_text"] is None


def test_preference_of_rules():
    # the first selector that matches anything decides; descendants only; nested cards each give a row
    html = ("<div class='annonce price'><div class='ANNONCE'><a href='/x' class='Title'>T</a><span class='prix'>7</span></div>"
            "<h2>H</h2><em class=price>8</em><li class=item>12.5 M2</li><li class=item>m2</li><li class=tag>3 Pièces</li></div><div class='ad-card'>no</div>")
    cards = scan(html)["cards"]
    assert [(c["titre"], c["price_text"], c["surface_text"], c["pieces_text"], c["href"]) for c in cards] == [
        ("T", "8", "12.5 m2", "3 pièces", "/x"), ("T", "7", None, None, "/x")]
    # no container at all: parents of listing links, one row a link
    html = "<section><h3>S</h3><a href='/annonces/1'>1</a><a href='/annonces/2'>2</a></section>"
    assert [(c["titre"], c["href"]) for c in scan(html)["cards"]] == [("S", "/annonces/1")] * 2
    row = scan("<div itemprop=description> a <b> b</b></div><img data-src=x><img data-src=y/><p class=DPE>Classe <b>d</b></p>")
    assert row["description"] == "ab" and row["nb_photos"] == 2 and row["dpe_text"] == "Classed"


def test_details_join_once_and_searches_are_capped(spark):
    page = lambda *ids: "".join(f"<div class='ad-card'><h2>Maison {i}</h2><a href='/annonces/{i}{x}'>v</a></div>" for i, x in ids)
    search = "https://X.example/annonce/vente-maison-lyon-69?page={}"
    pages = spark.createDataFrame([(1, search.format(2), page((4, ""), (1, "/"))), (2, search.format(1), page((1, "#a"), (2, ""), (3, ""))),
                                   (3, "https://x.example/annonce/vente-maison-lille-59", page((1, ""))), (4, "https://x.example/autre", page((9, "")))],
                                  "page_id long, url string, html string")
    cards = PG.search_listings(PG.cards_of(PG.scan_pages(pages)), 3)
    assert sorted((r.city_search, r.property_type_search, r.page, r.titre) for r in cards.collect()) == [
        ("lille-59", "maison", 1, "Maison 1"), ("lyon-69", "maison", 1, "Maison 1"), ("lyon-69", "maison", 1, "Maison 2"), ("lyon-69", "maison", 1, "Maison 3")]
    details = spark.createDataFrame([(8, "https://x.example/annonces/1/", "<p class=dpe>A</p>"), (7, "https://x.EXAMPLE/annonces/1", "<p class=dpe>B</p>"), (9, None, "")],
                                    "page_id long, url string, html string")
    merged = PG.merge_cards_details(cards, PG.page_details(details)).collect()
    assert len(merged) == 4 and [r.dpe_classe for r in merged if r.titre == "Maison 1"] == ["B", "B"]


def test_pages_go_back_in_batches(monkeypatch):
    import pyarrow as pa
    odd = ["<p class=dpe>A</p>", "<script>var a='<p class=dpe>'</script><p class=dpe>B", None, "<p class=dpe/>C<div class='ad-card'/>", "<p class=dpe>" * 2, PAGE, DETAIL]
    html = odd * 60
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": None, "html": h} for i, h in enumerate(html)])
    want = [{"page_id": i, "url": None, **scan(h or "")} for i, h in enumerate(html)]
    sizes = {}
    for name, pages, chars in (("whole", 1_000, 10 ** 6), ("pages", 100, 10 ** 6), ("long", 1_000, 2_000)):
        monkeypatch.setattr(PG, "BATCH_PAGES", pages)
        monkeypatch.setattr(PG, "BATCH_CHARS", chars)
        out = list(PG._scan(iter([batch])))
        assert [r for b in out for r in b.to_pylist()] == want
        sizes[name] = [b.num_rows for b in out]
    assert sizes["whole"] == [420] and sizes["pages"] == [100] * 4 + [20] and max(sizes["long"]) <= 20
    monkeypatch.setattr(PG, "KEPT_TAGS", 2)               # forgetting kept tags changes nothing
    assert [r for b in PG._scan(iter([batch])) for r in b.to_pylist()] == want


def test_kept_start_tags_are_not_read_again(monkeypatch):
    read = []
    real = PG.Scanner.matched
    monkeypatch.setattr(PG.Scanner, "matched", lambda self, tag, attrs: read.append(tag) or real(self, tag, attrs))
    kept = {}
    rows = [PG.Scanner(kept).finish("<title><p></title><div class='ad-card'><h2 class=title>T</h2><textarea><p></textarea></div>").row() for _ in range(3)]
    assert rows[0] == rows[1] == rows[2] and [c["titre"] for c in rows[0]["cards"]] == ["T"]
    assert read.count("div") == read.count("h2") == 1 and read.count("title") == 3


def test_pages_join_on_a_column(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cards = spark.createDataFrame([(1, "https://X.example/a/#t")], "page_id long, url string")
        details = spark.createDataFrame([(7, "https://x.example/a", "A")], "page_id long, url string, dpe_classe string")
        df = PG.merge_cards_details(cards, details)
        sorts = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in x or "Exchange hash" in x]
        assert sorts and not any("regexp" in x for x in sorts)
        assert df.first().dpe_classe == "A"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_detail_pages_are_dealt_to_all_cores(spark, tmp_path):
    from parcelle.plans import queries_pages as Q
    from parcelle.sources import tables as T
    from tests.conftest import SF_SMALL
    for name in ("orders", "lineitem", "customer"):              # one file with one row group each
        T.read(spark, SF_SMALL, name).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    pages = Q.detail_pages(spark, str(tmp_path)).where("page_id < 1000000000000")
    sizes = [len(p) for p in pages.select("page_id").rdd.glom().collect()]
    assert sum(sizes) == pages.count() > 100 and max(sizes) < sum(sizes) / 4
