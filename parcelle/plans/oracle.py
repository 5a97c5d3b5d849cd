"""DuckDB SQL twins of the adapter (``parcelle.sources.tables``) and helpers.

Every oracle query is ``WITH <adapter CTEs> <query>`` over the driver's views.
Unused CTEs cost nothing.  Doubles are rounded by ``r`` on both sides the same way.
"""

from __future__ import annotations


def r(expr: str, d: int = 2) -> str:
    """Round a DOUBLE to ``d`` decimals exactly as ``parcelle.functions.rnd``
    does in Spark: scale, round half away from zero to an integer, unscale.
    Both engines then perform the same IEEE operations on the same double."""
    scale = f"CAST(1e{d} AS DOUBLE)"
    v = f"(ROUND(CAST(({expr}) AS DOUBLE) * {scale}) / {scale})"
    # -0.0 -> 0.0 (Spark's rounding never yields a negative zero)
    return f"(CASE WHEN {v} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {v} END)"


ADAPTER = """
lines_agg AS (
  SELECT l_orderkey, SUM(l_quantity) AS _surface, CAST(COUNT(*) AS INTEGER) AS _pieces
  FROM lineitem GROUP BY l_orderkey
),
sales_base AS (
  SELECT o.o_orderkey AS id,
         CAST(o.o_orderdate AS DATE) AS date_mutation,
         o.o_orderstatus AS nature_mutation,
         o.o_totalprice AS valeur_fonciere,
         o.o_orderpriority AS type_local,
         l._pieces AS nb_pieces,
         l._surface AS surface_reelle_bati,
         CAST(c.c_nationkey AS BIGINT) AS commune_id,
         lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS code_commune,
         CASE WHEN o.o_orderkey % 4 <> 0
              THEN lpad(CAST(c.c_nationkey % 7 * 1000 + 1000 AS VARCHAR), 5, '0') END AS code_postal,
         CASE WHEN o.o_orderkey % 3 <> 0 THEN 'voie ' || CAST(o.o_custkey AS VARCHAR) END AS adresse_nom_voie,
         CASE WHEN o.o_orderkey % 10 <> 0
              THEN 42.0 + CAST((o.o_custkey * 37) % 900 AS DOUBLE) / 100.0 END AS latitude,
         CASE WHEN o.o_orderkey % 10 <> 0
              THEN -4.0 + CAST((o.o_custkey * 53) % 1200 AS DOUBLE) / 100.0 END AS longitude
  FROM orders o
  LEFT JOIN lines_agg l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
sales AS (
  SELECT *,
         CASE WHEN surface_reelle_bati > 0
               AND valeur_fonciere / surface_reelle_bati BETWEEN 500 AND 20000
              THEN valeur_fonciere / surface_reelle_bati END AS prix_m2,
         CAST(year(date_mutation) AS INTEGER) AS annee,
         CAST(month(date_mutation) AS INTEGER) AS mois,
         CAST(quarter(date_mutation) AS INTEGER) AS trimestre,
         CAST(dayofweek(date_mutation) AS INTEGER) AS jour_semaine
  FROM sales_base
),
communes AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id,
         lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') AS code_commune,
         n.n_name AS nom_commune,
         lpad(CAST(n.n_nationkey % 7 * 1000 + 1000 AS VARCHAR), 5, '0') AS code_postal,
         r.r_name AS departement,
         r.r_name AS region,
         CAST(p._ncust * 1000 AS INTEGER) AS population,
         CAST(n.n_nationkey + 10 AS DOUBLE) AS superficie_km2,
         CAST(p._ncust * 1000 AS INTEGER) / NULLIF(CAST(n.n_nationkey + 10 AS DOUBLE), 0) AS densite_pop,
         42.0 + CAST(n.n_nationkey % 5 * 2 AS DOUBLE) AS latitude,
         -4.0 + CAST(n.n_nationkey % 6 * 2 AS DOUBLE) AS longitude
  FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, COUNT(*) AS _ncust FROM customer GROUP BY c_nationkey) p
         ON n.n_nationkey = p.c_nationkey
),
quartiers AS (
  SELECT id, id AS commune_id, 'Q-' || nom_commune AS nom_quartier,
         [ {'lon': longitude, 'lat': latitude}, {'lon': longitude + 1.0, 'lat': latitude},
           {'lon': longitude + 1.0, 'lat': latitude + 1.0}, {'lon': longitude, 'lat': latitude + 1.0},
           {'lon': longitude, 'lat': latitude} ] AS ring,
         CAST(id % 10 AS DOUBLE) / 2.0 AS score_qualite_vie
  FROM communes
),
poi AS (
  SELECT s_suppkey AS id,
         (['transport', 'ecole', 'commerce'])[CAST(s_suppkey % 3 AS INTEGER) + 1] AS type_poi,
         s_name AS nom,
         CAST(s_nationkey AS BIGINT) AS commune_id,
         42.0 + CAST((s_suppkey * 37) % 900 AS DOUBLE) / 100.0 AS latitude,
         -4.0 + CAST((s_suppkey * 53) % 1200 AS DOUBLE) / 100.0 AS longitude
  FROM supplier
),
listings AS (
  SELECT o.o_orderkey AS id,
         'L' || CAST(o.o_orderkey AS VARCHAR) AS listing_id,
         'https://annonces.example/' || CAST(o.o_orderkey AS VARCHAR) AS url,
         o.o_orderdate AS date_scraped,
         (o.o_orderkey % 2 = 0) AS is_active,
         o.o_totalprice * 1.05 AS prix_affiche,
         l._surface AS surface_habitable,
         l._pieces AS nb_pieces,
         CAST(c.c_nationkey AS BIGINT) AS commune_id,
         42.0 + CAST((o.o_custkey * 37) % 900 AS DOUBLE) / 100.0 AS latitude,
         -4.0 + CAST((o.o_custkey * 53) % 1200 AS DOUBLE) / 100.0 AS longitude
  FROM orders o
  LEFT JOIN lines_agg l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus = 'O'
),
price_history AS (
  SELECT event_id AS id, user_id AS listing_id, value AS prix, ts AS date_observation FROM events
),
raw_sales AS (
  SELECT id,
         CASE WHEN id % 2 = 0 THEN strftime(date_mutation, '%d/%m/%Y')
              ELSE strftime(date_mutation, '%Y-%m-%d') END AS date_mutation,
         CASE WHEN id % 5 = 0
              THEN ' ' || replace(CAST(CAST(valeur_fonciere AS DECIMAL(14,2)) AS VARCHAR), '.', ',')
              ELSE replace(CAST(CAST(valeur_fonciere AS DECIMAL(14,2)) AS VARCHAR), '.', ',') END AS valeur_fonciere,
         CASE WHEN id % 3 = 0 THEN CAST(CAST(substr(code_commune, 1, 2) AS INTEGER) AS VARCHAR) || '.0'
              ELSE CAST(CAST(substr(code_commune, 1, 2) AS INTEGER) AS VARCHAR) END AS code_departement,
         CASE WHEN id % 3 = 0 THEN CAST(commune_id AS VARCHAR) || '.0'
              ELSE CAST(commune_id AS VARCHAR) END AS code_commune,
         CASE WHEN id % 3 = 1 THEN code_postal || '.0' ELSE code_postal END AS code_postal,
         CAST(surface_reelle_bati AS VARCHAR) AS surface_reelle_bati,
         CAST(nb_pieces AS VARCHAR) AS nb_pieces,
         type_local,
         nature_mutation
  FROM sales_base
)
"""


def with_adapter(body: str) -> str:
    return "WITH " + ADAPTER.strip() + "\n" + body.strip()


def with_ctes(*ctes: str, body: str) -> str:
    """Adapter CTEs, then extra named CTEs, then the query body."""
    return with_adapter("").rstrip() + ",\n" + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()
