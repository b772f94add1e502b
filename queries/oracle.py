"""The same questions in DuckDB SQL, written from the rules and not from the library.

Money is counted in whole cents so that no rounding depends on binary fractions.
"""

from __future__ import annotations

from queries import raw
from queries.tables import AS_OF, EQUIPMENT, RUNS_AS_OF

ORACLE: dict[str, str] = {}


def duck(sql: str) -> str:
    return sql.replace("`", '"')


def half_up(numerator: str, denominator: str) -> str:
    """Quotient of non-negative whole numbers rounded half up to a whole number."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def mean6(cents: str, number: str) -> str:
    """Mean of cents as an amount with six decimals."""
    return f"CAST({half_up(f'({cents}) * 10000', number)} AS DOUBLE) / 1e6"


BLANK = "' ' || chr(160) || chr(9)"


def strip(column: str) -> str:
    return f"trim(coalesce({column}, ''), {BLANK})"


NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def number(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {NUMBER}) THEN TRY_CAST({text} AS DOUBLE) END"


def whole(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN TRY_CAST({text} AS INTEGER) END"


def date(text: str) -> str:
    pattern = "'^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$'"
    return f"CASE WHEN regexp_matches({text}, {pattern}) THEN TRY_CAST({text} AS DATE) END"


COMMUNES = """communes AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS code_insee, s_name AS nom, n_name AS dept, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
# p is in cents and q in whole square metres, so cents per m2 = p / q.
SALES = f"""sales AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS commune_id, CAST(l_shipdate AS DATE) AS jour, l_returnflag AS type_bien,
         p, q, {half_up("p", "q")} AS m2, q AS surf, CAST(year(l_shipdate) AS INTEGER) AS annee
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS p, CAST(l_quantity AS BIGINT) AS q
        FROM lineitem))"""

FIGURES = f"""count(*) AS nb_transactions, median(p) / 100 AS prix_median, median(m2) / 100 AS prix_m2_median,
  {mean6("sum(p)", "count(*)")} AS prix_moyen, {mean6("sum(100 * surf)", "count(*)")} AS surface_moyenne"""

ORACLE["price_stats_commune"] = f"""WITH {COMMUNES}, {SALES}
SELECT commune_id, nom AS commune_nom, dept, region, {FIGURES}
FROM sales JOIN communes ON commune_id = code_insee
WHERE jour >= DATE '{AS_OF}' - INTERVAL 12 MONTH
GROUP BY commune_id, nom, dept, region"""

ORACLE["energy_stats_commune"] = f"""WITH {COMMUNES}, dpe AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS commune_id, chr(64 + l_linenumber) AS classe,
         CAST(l_quantity AS BIGINT) * 100 AS conso, CAST(round(l_tax * 100) AS BIGINT) AS ges FROM lineitem)
SELECT commune_id, nom AS commune_nom, count(*) AS nb_dpe,
  count(*) FILTER (classe <= 'C') AS nb_bonne_perf, count(*) FILTER (classe >= 'F') AS nb_mauvaise_perf,
  CAST({half_up("10000 * count(*) FILTER (classe <= 'C')", "count(*)")} AS DOUBLE) / 100
    AS pct_bonne_perf,
  {mean6("sum(conso)", "count(*)")} AS conso_energie_moyenne,
  {mean6("sum(ges)", "count(*)")} AS emissions_co2_moyenne
FROM dpe JOIN communes ON commune_id = code_insee GROUP BY commune_id, nom"""

ORACLE["dept_price_top10"] = f"""WITH {COMMUNES}, {SALES}
SELECT dept, count(*) AS nb_transactions, {mean6("sum(p)", "count(*)")} AS prix_moyen
FROM sales JOIN communes ON commune_id = code_insee
GROUP BY dept ORDER BY nb_transactions DESC, dept LIMIT 10"""

ORACLE["stats_by_level"] = f"""WITH {COMMUNES}, {SALES}
SELECT CASE GROUPING(region, dept, commune_id) WHEN 7 THEN 'national' WHEN 3 THEN 'region'
            WHEN 1 THEN 'dept' ELSE 'commune' END AS level,
  region, dept, commune_id, {FIGURES}
FROM sales JOIN communes ON commune_id = code_insee
GROUP BY GROUPING SETS ((region, dept, commune_id), (region, dept), (region), ())"""

ORACLE["price_yoy"] = f"""WITH {COMMUNES}, {SALES}, yearly AS (
  SELECT dept AS area, annee, count(*) AS nb_transactions, median(p) / 100 AS prix_median
  FROM sales JOIN communes ON commune_id = code_insee GROUP BY dept, annee)
SELECT a.area, a.annee, a.nb_transactions, a.prix_median, b.prix_median AS prix_median_before,
  round(a.prix_median - b.prix_median, 3) AS change,
  round(100 * (a.prix_median - b.prix_median) / b.prix_median, 4) AS change_pct
FROM yearly a LEFT JOIN yearly b ON a.area = b.area AND a.annee = b.annee + 1"""

ORACLE["area_vs_parent"] = f"""WITH {COMMUNES}, {SALES}, placed AS (
  SELECT * FROM sales JOIN communes ON commune_id = code_insee),
c AS (SELECT region, dept, commune_id, median(p) / 100 AS m FROM placed GROUP BY ALL),
d AS (SELECT region, dept, median(p) / 100 AS m FROM placed GROUP BY ALL)
SELECT commune_id, c.dept AS dept, c.m AS prix_median, d.m AS dept_median,
  (SELECT median(p) / 100 FROM placed) AS national_median,
  round(c.m / d.m, 6) AS ratio_dept,
  round(c.m / (SELECT median(p) / 100 FROM placed), 6) AS ratio_national,
  percent_rank() OVER (PARTITION BY c.region, c.dept ORDER BY c.m) AS rank_pct
FROM c JOIN d ON c.region = d.region AND c.dept = d.dept"""

DEMOGRAPHICS = """demographics AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS commune_id, CAST(year(l_shipdate) AS INTEGER) AS annee,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS population,
         CAST(year(l_shipdate) * 10 AS DOUBLE) AS revenu_median
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate))"""

ORACLE["affordability_indicators"] = f"""WITH {SALES}, {DEMOGRAPHICS}
SELECT commune_id, annee, count(*) AS nb_transactions, median(p) / 100 AS prix_median,
  median(m2) / 100 AS prix_m2_median, any_value(population) AS population,
  any_value(revenu_median) AS revenu_median,
  round(median(p) / 100 / any_value(revenu_median), 4) AS years_of_income,
  round(1000.0::DOUBLE * count(*) / any_value(population), 4) AS sales_per_1000
FROM sales JOIN demographics USING (commune_id, annee) GROUP BY commune_id, annee"""

INFRASTRUCTURE = """infrastructure AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS commune_id, p_type AS type_equipement, CAST(l_quantity AS INTEGER) AS nombre
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

ORACLE["equipment_by_commune"] = f"""WITH {INFRASTRUCTURE}
SELECT commune_id, type_equipement, CAST(sum(nombre) AS BIGINT) AS nombre
FROM infrastructure GROUP BY commune_id, type_equipement"""

ORACLE["equipment_pivot"] = f"""WITH {INFRASTRUCTURE}
SELECT commune_id, {", ".join(
    f"CAST(coalesce(sum(nombre) FILTER (type_equipement = '{kind}'), 0) AS BIGINT) AS \"{kind}\""
    for kind in EQUIPMENT)}
FROM infrastructure GROUP BY commune_id"""

TERMS = r"""terms AS (
  SELECT lang, term, count(*) AS nb FROM (
    SELECT lang, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS term FROM documents)
  WHERE term <> '' GROUP BY lang, term)"""
ORACLE["term_counts"] = f"WITH {TERMS} SELECT lang, term, nb FROM terms"
ORACLE["top_terms"] = f"""WITH {TERMS}
SELECT lang, term, nb FROM terms
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY nb DESC, term) <= 50"""

# --- run history --------------------------------------------------------------------------------

RUNS = """k_events AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
runs AS (
  SELECT event_id AS id, event_type AS scraper_name, ts AS started_at,
    CASE WHEN k < 90 THEN ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 10000) END AS completed_at,
    CASE WHEN k < 70 THEN 'success' WHEN k < 90 THEN 'failed' ELSE 'running' END AS status,
    CASE WHEN k < 70 THEN CAST(k * 10 AS BIGINT) ELSE 0 END AS records_processed, props AS metadata
  FROM k_events)"""
DURATION = "(epoch_us(completed_at) - epoch_us(started_at)) / 1e6 AS duration_seconds"
RUN_COLUMNS = "scraper_name, started_at, completed_at, status, records_processed"

ORACLE["latest_run_per_loader"] = f"""WITH {RUNS}
SELECT {RUN_COLUMNS}, {DURATION} FROM runs
QUALIFY row_number() OVER (PARTITION BY scraper_name ORDER BY started_at DESC, id DESC) = 1"""

ORACLE["loader_success_stats"] = f"""WITH {RUNS}
SELECT scraper_name, count(*) AS total_runs,
  CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
  avg(records_processed) AS avg_records
FROM runs GROUP BY scraper_name"""

ORACLE["recent_runs_top10"] = f"""WITH {RUNS}
SELECT * FROM runs ORDER BY started_at DESC, id DESC LIMIT 10"""

ORACLE["runs_last_7_days"] = f"""WITH {RUNS}
SELECT id, {RUN_COLUMNS}, {DURATION} FROM runs
WHERE started_at >= TIMESTAMP '{RUNS_AS_OF}' - INTERVAL 7 DAY ORDER BY started_at DESC, id DESC"""

ORACLE["run_durations"] = f"WITH {RUNS} SELECT id, {DURATION} FROM runs"

ORACLE["load_success_ratio"] = f"""WITH {RUNS}
SELECT count(*) FILTER (status = 'success') AS nb_success, count(*) AS nb_total FROM runs"""

ORACLE["success_ratio_per_run"] = f"""WITH {RUNS}, loads AS (
  SELECT CAST(user_id AS VARCHAR) AS pipeline_id, status FROM runs JOIN events ON id = event_id)
SELECT pipeline_id, count(*) FILTER (status = 'success') AS nb_success, count(*) AS nb_total,
  CAST({half_up("10000 * count(*) FILTER (status = 'success')", "count(*)")} AS DOUBLE) / 100 AS pct_success
FROM loads GROUP BY pipeline_id"""

ORACLE["run_ledger_fold"] = f"""WITH {RUNS}
SELECT id, scraper_name, started_at, completed_at, status, records_processed,
  CASE WHEN status = 'failed' THEN 'error in ' || scraper_name END AS error_message, metadata
FROM runs"""

ORACLE["metadata_json_roundtrip"] = f"""WITH {RUNS}
SELECT event_id, CASE WHEN k < 90 THEN event_type END AS department,
  CASE WHEN k < 80 THEN CAST(year(ts) AS INTEGER) END AS year, k >= 90 AS no_metadata
FROM k_events"""

# --- cleaning -----------------------------------------------------------------------------------

TX_PARSED = f"""raw AS ({duck(raw.TRANSACTIONS)}),
fields AS (
  SELECT {strip("code_commune")} AS code, {strip("date_mutation")} AS jour, {strip("valeur_fonciere")} AS valeur,
    {strip("type_local")} AS label, {strip("surface_reelle_bati")} AS bati,
    {strip("nombre_pieces_principales")} AS pieces, {strip("nature_mutation")} AS nature_mutation,
    {strip("adresse_numero || ' ' || adresse_nom_voie")} AS adresse, {strip("code_postal")} AS code_postal
  FROM raw),
parsed AS (
  SELECT *, {date("jour")} AS d, {number("valeur")} AS v, {number("bati")} AS s, {whole("pieces")} AS n FROM fields),
judged AS (
  SELECT *, CASE WHEN code = '' OR jour = '' OR valeur = '' THEN 'blank_required'
    WHEN d IS NULL OR v IS NULL OR (bati <> '' AND s IS NULL) OR (pieces <> '' AND n IS NULL)
      THEN 'unreadable_value' ELSE 'loaded' END AS reason
  FROM parsed)"""
TYPE_BIEN = """CASE label WHEN 'Maison' THEN 'maison' WHEN 'Appartement' THEN 'appartement'
    WHEN 'Dépendance' THEN 'dependance' WHEN 'Local industriel. commercial ou assimilé' THEN 'local_commercial'
    ELSE 'autre' END"""

TX_COLUMNS = f"""code AS commune_id, d AS date_transaction, v AS prix, s AS surface,
  CASE WHEN s > 0 THEN CAST({half_up("CAST(round(v * 100) AS BIGINT)", "CAST(s AS BIGINT)")} AS DOUBLE) / 100 END
    AS prix_m2,
  {TYPE_BIEN} AS type_bien, n AS nombre_pieces, nature_mutation, adresse, code_postal"""
ORACLE["clean_transactions"] = f"WITH {TX_PARSED} SELECT {TX_COLUMNS} FROM judged WHERE reason = 'loaded'"
ORACLE["transactions_from_csv"] = ORACLE["clean_transactions"]
ORACLE["stored_transactions"] = f"""WITH {TX_PARSED}
SELECT {TX_COLUMNS}, CAST(year(d) AS INTEGER) AS year FROM judged
WHERE reason = 'loaded' AND length(code) <= 5 AND code IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)"""
ORACLE["quarantined_transactions"] = f"""WITH {TX_PARSED}, reasons AS (
  SELECT unnest(CASE WHEN reason <> 'loaded' THEN [reason] ELSE
    [CASE WHEN length(code) > 5 THEN 'commune_id_length' END,
     CASE WHEN length(code) > 5 OR code NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)
       THEN 'commune_unknown' END] END) AS violation FROM judged)
SELECT violation, count(*) AS nb_rows FROM reasons WHERE violation IS NOT NULL GROUP BY violation"""

ORACLE["rejected_transactions"] = f"""WITH {TX_PARSED}
SELECT reason, count(*) AS nb_rows FROM judged GROUP BY reason"""

ORACLE["map_type_bien"] = f"""WITH {TX_PARSED}
SELECT label, {TYPE_BIEN} AS type_bien, count(*) AS nb FROM fields GROUP BY ALL"""

TYPE_BATIMENT = """CASE WHEN lower(label) LIKE '%appartement%' THEN 'appartement'
    WHEN lower(label) LIKE '%maison%' OR lower(label) LIKE '%individuel%' THEN 'maison'
    WHEN lower(label) LIKE '%immeuble%' THEN 'immeuble' ELSE 'autre' END"""
DPE_PARSED = f"""raw AS ({duck(raw.DPE)}),
fields AS (
  SELECT {strip('"Code_INSEE_(BAN)"')} AS code, upper({strip('"Etiquette_DPE"')}) AS classe,
    upper({strip('"Etiquette_GES"')}) AS ges_label, {strip('"Conso_5_usages_é_finale"')} AS conso,
    {strip('"Emission_GES_5_usages"')} AS ges, {strip('"Type_bâtiment"')} AS label,
    {strip('"Année_construction"')} AS annee, {strip('"Surface_habitable_logement"')} AS surf,
    {strip('"Date_établissement_DPE"')} AS jour
  FROM raw),
parsed AS (
  SELECT *, {number("conso")} AS c, {number("ges")} AS g, {number("surf")} AS s, {whole("annee")} AS a,
    {date("jour")} AS d FROM fields),
judged AS (
  SELECT *, (conso = '' OR c IS NOT NULL) AND (ges = '' OR g IS NOT NULL) AND (surf = '' OR s IS NOT NULL)
    AND (annee = '' OR a IS NOT NULL) AND (jour = '' OR d IS NOT NULL) AS readable
  FROM parsed)"""

ORACLE["clean_dpe"] = f"""WITH {DPE_PARSED}
SELECT code AS commune_id, classe AS classe_energetique,
  CASE WHEN ges_label IN ('A', 'B', 'C', 'D', 'E', 'F', 'G') THEN ges_label END AS classe_ges,
  CASE WHEN readable THEN g END AS emissions_co2, CASE WHEN readable THEN c END AS consommation_energie,
  {TYPE_BATIMENT} AS type_batiment, CASE WHEN readable THEN a END AS annee_construction,
  CASE WHEN readable THEN s END AS surface, CASE WHEN readable THEN d END AS date_etablissement
FROM judged WHERE code <> '' AND classe IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')"""
ORACLE["dpe_from_csv"] = ORACLE["clean_dpe"]

ORACLE["map_type_batiment"] = f"""WITH {DPE_PARSED}
SELECT label, {TYPE_BATIMENT} AS type_batiment, count(*) AS nb FROM fields GROUP BY ALL"""

COMMUNE_PARSED = f"""raw AS ({raw.COMMUNES}),
fields AS (
  SELECT {strip("com_code")} AS code_insee, {strip("com_nom")} AS nom, {strip("dep_code")} AS dept,
    {strip("reg_nom")} AS region, {strip("latitude")} AS lat, {strip("longitude")} AS lon, _pos FROM raw),
parsed AS (SELECT *, {number("lat")} AS y, {number("lon")} AS x FROM fields),
cleaned AS (
  SELECT code_insee, nom, dept, region,
    CASE WHEN (lat = '' OR y IS NOT NULL) AND (lon = '' OR x IS NOT NULL) THEN y END AS latitude,
    CASE WHEN (lat = '' OR y IS NOT NULL) AND (lon = '' OR x IS NOT NULL) THEN x END AS longitude, _pos
  FROM parsed WHERE code_insee <> '' AND nom <> '' AND dept <> '')"""
ORACLE["clean_communes"] = f"""WITH {COMMUNE_PARSED}
SELECT code_insee, nom, dept, region, latitude, longitude FROM cleaned"""
ORACLE["communes_from_csv"] = ORACLE["clean_communes"]

ORACLE["upsert_communes"] = f"""WITH {COMMUNE_PARSED}, {COMMUNES}, folded AS (
  SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY code_insee ORDER BY _pos DESC) = 1)
SELECT coalesce(f.code_insee, c.code_insee) AS code_insee,
  CASE WHEN f.code_insee IS NOT NULL THEN f.nom ELSE c.nom END AS nom,
  CASE WHEN f.code_insee IS NOT NULL THEN f.dept ELSE c.dept END AS dept,
  CASE WHEN f.code_insee IS NOT NULL THEN f.region ELSE c.region END AS region,
  f.latitude AS latitude, f.longitude AS longitude, CAST(c.code_insee AS INTEGER) AS population_actuelle,
  CASE WHEN c.code_insee IS NOT NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2024-06-01' END AS created_at,
  CASE WHEN c.code_insee IS NOT NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2024-06-01' END AS updated_at
FROM communes c FULL JOIN folded f ON c.code_insee = f.code_insee"""


def figure(sql: str, code: str, value: str, read: str, name: str) -> str:
    """CTE ``name``: last readable value per code."""
    return f"""{name} AS (
  SELECT code AS commune_id, v AS {name} FROM (
    SELECT code, {read} AS v, _pos FROM (
      SELECT {strip(code)} AS code, {strip(value)} AS text, _pos FROM ({sql})))
  WHERE code <> '' AND v IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY _pos DESC) = 1)"""


POPULATION = figure(raw.POPULATION, "COM", "PMUN", whole("text"), "population")
INCOME = figure(raw.INCOME, "CODGEO", "MED21", number("text"), "revenu_median")
ORACLE["clean_population"] = f"WITH {POPULATION} SELECT commune_id, population, 2021 AS annee FROM population"
ORACLE["population_from_csv"] = ORACLE["clean_population"]
ORACLE["clean_income"] = f"WITH {INCOME} SELECT commune_id, revenu_median FROM revenu_median"
ORACLE["income_from_csv"] = ORACLE["clean_income"]
ORACLE["merge_demographics"] = f"""WITH {POPULATION}, {INCOME}
SELECT coalesce(p.commune_id, r.commune_id) AS commune_id, 2021 AS annee, p.population AS population,
  CAST(NULL AS DOUBLE) AS densite, r.revenu_median AS revenu_median, CAST(NULL AS DOUBLE) AS taux_chomage,
  CAST(NULL AS INTEGER) AS nombre_menages, CAST(NULL AS DOUBLE) AS taille_moyenne_menage
FROM population p FULL JOIN revenu_median r ON p.commune_id = r.commune_id"""

ORACLE["price_per_square_metre"] = f"""SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
  CAST({half_up("CAST(round(l_extendedprice * 100) AS BIGINT)", "CAST(l_quantity AS BIGINT)")} AS DOUBLE) / 100
    AS prix_m2
FROM lineitem"""

# --- sources ------------------------------------------------------------------------------------

KNOWN = "(SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)"
ORACLE["streamed_transactions"] = ORACLE["stored_transactions"]
ORACLE["streamed_redelivery"] = ORACLE["stored_transactions"]
ORACLE["snapshot_load"] = ORACLE["stored_transactions"]
BOTH_WAYS = "(SELECT unnest([false, true]) AS compacted)"
ORACLE["cascade_by_bitmap"] = f"""SELECT s.*, compacted FROM ({ORACLE["stored_transactions"]}) s, {BOTH_WAYS}
WHERE commune_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0)"""
ORACLE["upsert_by_delta"] = f"SELECT u.*, compacted FROM ({ORACLE['upsert_communes']}) u, {BOTH_WAYS}"
COMMUNES_LEFT = COMMUNES.replace("FROM supplier", "FROM (SELECT * FROM supplier WHERE (s_acctbal < 0) IS NOT TRUE)")
ORACLE["kept_price_stats"] = ORACLE["price_stats_commune"].replace(COMMUNES, COMMUNES_LEFT)
ORACLE["kept_stats_by_level"] = ORACLE["stats_by_level"].replace(COMMUNES, COMMUNES_LEFT)
ORACLE["kept_price_yoy"] = ORACLE["price_yoy"].replace(COMMUNES, COMMUNES_LEFT)
ORACLE["stored_dpe"] = f"SELECT * FROM ({ORACLE['clean_dpe']}) WHERE commune_id IN {KNOWN}"
ORACLE["stored_demographics"] = f"""SELECT * REPLACE (2001 AS annee) FROM ({ORACLE["merge_demographics"]})
WHERE commune_id IN {KNOWN}"""


def rejected_figures(source: str, code: str, value: str, read: str, sql: str) -> str:
    return f"""SELECT '{source}' AS source, CASE WHEN code = '' OR text = '' THEN 'blank_required'
    WHEN length(code) > 5 THEN 'commune_id_length' ELSE 'unreadable_value' END AS violation
  FROM (SELECT {strip(code)} AS code, {strip(value)} AS text FROM ({sql}))
  WHERE code = '' OR text = '' OR {read} IS NULL OR length(code) > 5"""


ORACLE["quarantined_rows"] = f"""SELECT source, violation, count(*) AS nb_rows FROM (
  SELECT 'transactions' AS source, violation, unnest(range(nb_rows)) FROM ({ORACLE["quarantined_transactions"]})
  UNION ALL SELECT source, violation, 0 FROM ({rejected_figures("population", "COM", "PMUN", whole("text"), raw.POPULATION)})
  UNION ALL SELECT source, violation, 0 FROM ({rejected_figures("income", "CODGEO", "MED21", number("text"), raw.INCOME)})
  UNION ALL SELECT 'demographics', 'commune_unknown', 0 FROM ({ORACLE["merge_demographics"]}) WHERE commune_id NOT IN {KNOWN}
  UNION ALL (WITH {DPE_PARSED} SELECT 'dpe', CASE WHEN code = '' OR classe = '' THEN 'blank_required' ELSE 'unknown_label' END, 0
    FROM judged WHERE code = '' OR classe = '' OR classe NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'G'))
  UNION ALL SELECT 'dpe', 'commune_unknown', 0 FROM ({ORACLE["clean_dpe"]}) WHERE commune_id NOT IN {KNOWN})
GROUP BY source, violation"""

ORACLE["load_ledger"] = f"""SELECT name || '_loader' AS scraper_name, 'success' AS status, n AS records_processed,
  n AS table_total, true AS closed
FROM (SELECT 'communes' AS name, count(*) AS n FROM supplier
      UNION ALL SELECT 'transactions', count(*) FROM ({ORACLE["stored_transactions"]})
      UNION ALL SELECT 'demographics', count(*) FROM ({ORACLE["stored_demographics"]})
      UNION ALL SELECT 'dpe', count(*) FROM ({ORACLE["stored_dpe"]}))"""

ORACLE["dpe_by_department"] = f"""WITH {COMMUNES}, cleaned AS ({ORACLE["clean_dpe"]})
SELECT cleaned.* FROM cleaned JOIN communes ON commune_id = code_insee
WHERE dept IN ('NATION_1', 'NATION_7', 'NATION_12')"""

ORACLE["folder_choice"] = ORACLE["clean_transactions"].replace(
    "raw AS (", f"raw AS (SELECT * FROM ({duck(raw.placed(raw.TRANSACTIONS))}) WHERE year IN (1996, 1999) AND dept IN ('1', '3')), unused AS ("
)

ORACLE["damaged_rows"] = """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'short_row'
    WHEN '4-NOT SPECIFIED' THEN 'bad_encoding' ELSE 'whole' END AS state,
  CASE WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN CAST(o_custkey AS VARCHAR)
       WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey || ';"x"' END AS com,
  CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM', '5-LOW') THEN CAST(o_orderkey AS VARCHAR) END AS pmun
FROM orders"""

ORACLE["dept_union_load"] = f"""WITH {COMMUNES}
SELECT code_insee AS commune_id, dept, CAST(l_shipdate AS DATE) AS date_transaction, l_extendedprice AS prix,
  l_quantity AS surface
FROM lineitem JOIN communes ON CAST(l_suppkey AS VARCHAR) = code_insee
WHERE dept IN ('NATION_1', 'NATION_7', 'NATION_12')"""

ORACLE["table_counts"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS nb_records FROM {name}"
    for name in (
        "region nation customer supplier part orders lineitem events "
        "documents embeddings pages benchmark labels conversations"
    ).split()
)

ORACLE["param_query"] = """SELECT event_type, count(*) AS nb, max(value) AS max_value FROM events
WHERE value >= 5.0 AND event_type <> 'signup' GROUP BY event_type"""

# --- keyed loading and integrity ----------------------------------------------------------------

ORACLE["last_value_per_key"] = """SELECT o_custkey, o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS last_price, o_orderpriority
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1"""

CHILD = "SELECT o_custkey AS commune_id, o_orderkey, o_orderdate, o_totalprice FROM orders"
ORACLE["fk_loadable"] = f"{CHILD} WHERE o_custkey IN (SELECT s_suppkey FROM supplier)"
ORACLE["fk_orphans"] = f"{CHILD} WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)"

ORACLE["cascade_delete"] = f"""WITH {SALES}
SELECT commune_id, jour AS date_transaction, p / 100 AS prix, CAST(q AS DOUBLE) AS surface,
  CAST(m2 AS DOUBLE) / 100 AS prix_m2, type_bien
FROM sales
WHERE commune_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0)"""

ORDERS_YEARLY = """yearly AS (
  SELECT CAST(o_custkey AS VARCHAR) AS commune_id, CAST(year(o_orderdate) AS INTEGER) AS annee,
    CAST(o_orderkey AS INTEGER) AS population, o_totalprice AS revenu_median FROM orders)"""

ORACLE["unique_conflicts"] = f"""WITH {DEMOGRAPHICS}, {ORDERS_YEARLY}
SELECT commune_id, annee, count(*) AS nb_incoming, bool_or(stored) AS already_stored
FROM (SELECT y.commune_id, y.annee, d.commune_id IS NOT NULL AS stored
      FROM yearly y LEFT JOIN demographics d ON y.commune_id = d.commune_id AND y.annee = d.annee)
GROUP BY commune_id, annee HAVING count(*) > 1 OR bool_or(stored)"""

ORACLE["insert_skip_conflicts"] = f"""WITH {DEMOGRAPHICS}, {ORDERS_YEARLY}
SELECT * FROM yearly y
WHERE NOT EXISTS (SELECT 1 FROM demographics d WHERE d.commune_id = y.commune_id AND d.annee = y.annee)
QUALIFY row_number() OVER (PARTITION BY commune_id, annee ORDER BY population) = 1"""

ORACLE["insert_update_conflicts"] = f"""WITH {DEMOGRAPHICS}, {ORDERS_YEARLY}, folded AS (
  SELECT * FROM yearly QUALIFY row_number() OVER (PARTITION BY commune_id, annee ORDER BY population DESC) = 1)
SELECT * FROM folded UNION ALL
SELECT commune_id, annee, population, revenu_median FROM demographics d
WHERE NOT EXISTS (SELECT 1 FROM folded f WHERE d.commune_id = f.commune_id AND d.annee = f.annee)"""

ORACLE["demographics_update"] = f"""WITH {DEMOGRAPHICS}, {ORDERS_YEARLY}, folded AS (
  SELECT commune_id, annee, CASE WHEN population % 5 > 0 THEN population END AS population,
    CASE WHEN population % 3 > 0 THEN revenu_median END AS revenu_median
  FROM yearly QUALIFY row_number() OVER (PARTITION BY commune_id, annee ORDER BY population DESC) = 1)
SELECT commune_id, annee, coalesce(f.population, d.population) AS population,
  coalesce(f.revenu_median, d.revenu_median) AS revenu_median,
  CASE WHEN f.annee IS NOT NULL THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2020-01-01' END AS updated_at
FROM demographics d FULL JOIN folded f USING (commune_id, annee)"""

ORACLE["key_union"] = "SELECT o_custkey AS code FROM orders UNION SELECT l_partkey FROM lineitem"

VIOLATIONS = """SELECT * FROM (SELECT l_orderkey, unnest([
    CASE WHEN l_linenumber = 1 THEN 'commune_id_null' END,
    CASE WHEN l_linenumber = 7 THEN 'commune_id_length' END,
    CASE WHEN l_tax = 0.08 THEN 'prix_range' END,
    CASE WHEN l_discount = 0.1 AND l_quantity >= 1 THEN 'surface_range' END,
    CASE WHEN l_returnflag = 'R' THEN 'type_bien_length' END]) AS violation
FROM lineitem) WHERE violation IS NOT NULL"""
ORACLE["rule_violations"] = VIOLATIONS
ORACLE["quarantine_counts"] = f"SELECT violation, count(*) AS nb_rows FROM ({VIOLATIONS}) GROUP BY violation"

ORACLE["append_with_defaults"] = f"""WITH {INFRASTRUCTURE}
SELECT commune_id, type_equipement, CASE WHEN nombre > 25 THEN nombre ELSE 1 END AS nombre,
  CAST(NULL AS VARCHAR) AS nom, CAST(NULL AS VARCHAR) AS adresse, CAST(NULL AS DOUBLE) AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, TIMESTAMP '2024-06-01' AS created_at, TIMESTAMP '2024-06-01' AS updated_at
FROM infrastructure"""

ORACLE["redelivered_rows"] = """SELECT l_suppkey, l_quantity, l_returnflag FROM lineitem EXCEPT ALL
SELECT l_suppkey, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'R'"""

ORACLE["incremental_ingest"] = "SELECT o_orderkey, o_custkey, o_totalprice AS prix, o_orderdate FROM orders"

ORACLE["multiline_csv"] = """SELECT CAST(o_custkey AS VARCHAR) AS "COM",
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS "PMUN",
  CASE WHEN o_orderstatus = 'P' THEN NULL
       WHEN o_orderpriority = '1-URGENT' THEN 'first' || chr(10) || chr(10) || 'second'
       WHEN o_orderpriority = '2-HIGH' THEN '"x";' || chr(10) || 'y'
       WHEN o_orderpriority = '3-MEDIUM' THEN '5" wide'
       WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_totalprice AS VARCHAR) END AS note,
  CASE WHEN o_orderstatus = 'P' THEN 'short_row' END AS _damage
FROM orders"""
