"""Dirty source text made from the driver's tables by SQL that Spark and DuckDB both run.

The dirt follows the values of a row (discount, tax, quantity, ...), so it turns up at any scale.
"""

NBSP = "chr(160)"
PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)"
AREA = "CAST(CAST(l_quantity AS DECIMAL(10,2)) AS STRING)"
DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"

TRANSACTIONS = f"""
SELECT
  CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN ' ' ELSE concat(' ', CAST(l_suppkey AS STRING)) END
    AS code_commune,
  CASE WHEN l_discount = 0.01 THEN '2023-02-30'
       WHEN l_discount = 0.02 THEN ''
       WHEN l_discount = 0.03 THEN '2023-01'
       WHEN l_discount = 0.04 THEN concat(CAST(year(l_shipdate) AS STRING), '-',
            CAST(month(l_shipdate) AS STRING), '-', CAST(day(l_shipdate) AS STRING))
       WHEN l_discount = 0.05 THEN concat({DAY}, 'T00:00:00')
       ELSE {DAY} END AS date_mutation,
  CASE WHEN l_tax = 0.01 THEN 'n/a'
       WHEN l_tax = 0.02 THEN concat({PRICE}, 'd')
       WHEN l_tax = 0.03 THEN {NBSP}
       WHEN l_tax = 0.04 THEN concat({NBSP}, {PRICE}, 'e0 ')
       ELSE {PRICE} END AS valeur_fonciere,
  CASE WHEN l_linenumber = 7 THEN 'Local industriel. commercial ou assimilé'
       WHEN l_linenumber = 6 THEN 'Terrain'
       WHEN l_returnflag = 'A' THEN 'Maison'
       WHEN l_returnflag = 'N' THEN ' Appartement'
       WHEN l_linestatus = 'O' THEN 'Dépendance'
       ELSE '' END AS type_local,
  CASE WHEN l_quantity = 1 THEN '0'
       WHEN l_quantity = 2 THEN ''
       WHEN l_quantity = 3 THEN 'abc'
       WHEN l_quantity = 4 THEN '-5'
       WHEN l_quantity = 5 THEN 'nan'
       ELSE {AREA} END AS surface_reelle_bati,
  CASE WHEN l_linenumber = 5 AND l_linestatus = 'F' THEN '3.0'
       WHEN l_linenumber = 4 THEN ''
       ELSE CAST(l_linenumber AS STRING) END AS nombre_pieces_principales,
  CASE WHEN l_returnflag = 'R' THEN ' ' ELSE concat(' Vente ', {NBSP}) END AS nature_mutation,
  CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber AS STRING) END AS adresse_numero,
  CASE WHEN l_linenumber < 3 AND l_linestatus = 'F' THEN '' ELSE concat('RUE  ', CAST(l_partkey AS STRING), ' ') END
    AS adresse_nom_voie,
  lpad(CAST(l_suppkey AS STRING), 5, '0') AS code_postal
FROM lineitem"""

DPE = f"""
SELECT
  CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN '' ELSE CAST(l_suppkey AS STRING) END AS `Code_INSEE_(BAN)`,
  CASE WHEN l_linestatus = 'F' THEN concat(' ', lower(chr(64 + l_linenumber)))
       WHEN l_discount = 0.0 THEN 'H'
       WHEN l_discount = 0.1 THEN ''
       ELSE chr(64 + l_linenumber) END AS `Etiquette_DPE`,
  CASE WHEN l_tax = 0.0 THEN '' WHEN l_tax = 0.01 THEN 'Z' WHEN l_tax = 0.02 THEN 'e'
       ELSE chr(64 + l_linenumber) END AS `Etiquette_GES`,
  CASE WHEN l_tax = 0.03 THEN 'inconnu' ELSE {AREA} END AS `Conso_5_usages_é_finale`,
  CASE WHEN l_discount = 0.05 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS INT) AS STRING) END
    AS `Emission_GES_5_usages`,
  CASE p_type WHEN 'STANDARD' THEN 'Maison individuelle' WHEN 'MEDIUM' THEN 'Immeuble collectif'
       WHEN 'ECONOMY' THEN 'APPARTEMENT dans immeuble' WHEN 'PROMO' THEN 'Logement individuel'
       WHEN 'SMALL' THEN '' ELSE p_type END AS `Type_bâtiment`,
  CASE WHEN l_discount = 0.06 THEN '1948.0' ELSE CAST(1900 + p_size AS STRING) END AS `Année_construction`,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) AS `Surface_habitable_logement`,
  CASE WHEN l_discount = 0.07 THEN '' WHEN l_discount = 0.08 THEN '30/01/2023' ELSE {DAY} END
    AS `Date_établissement_DPE`
FROM lineitem JOIN part ON l_partkey = p_partkey"""

# One register row per order: a code comes up many times, the order key is the place in the file.
COMMUNES = f"""
SELECT
  concat(CAST(o_custkey AS STRING), {NBSP}) AS com_code,
  concat(' ', o_orderpriority) AS com_nom,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderstatus END AS dep_code,
  CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE o_orderstatus END AS reg_nom,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'x'
       WHEN o_orderpriority = '3-MEDIUM' THEN ''
       ELSE CAST(CAST(o_totalprice / 10000 AS DECIMAL(12,6)) AS STRING) END AS latitude,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '1_0'
       ELSE concat('-', CAST(CAST(o_totalprice / 5000 AS DECIMAL(12,6)) AS STRING)) END AS longitude,
  o_orderkey AS _pos
FROM orders"""

POPULATION = """
SELECT
  concat(' ', CAST(o_custkey AS STRING)) AS COM,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '1 200'
       WHEN o_orderpriority = '2-HIGH' THEN ''
       WHEN o_orderpriority = '3-MEDIUM' THEN '3.0'
       WHEN o_orderstatus = 'P' THEN '0'
       ELSE CAST(CAST(floor(o_totalprice) AS INT) AS STRING) END AS PMUN,
  o_orderkey AS _pos
FROM orders"""

INCOME = """
SELECT
  CASE WHEN p_type = 'LARGE' THEN '' ELSE CAST(p_partkey AS STRING) END AS CODGEO,
  CASE WHEN p_type = 'SMALL' THEN 's' WHEN p_type = 'PROMO' THEN ' '
       ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END AS MED21,
  p_partkey AS _pos
FROM part"""


def placed(sql: str) -> str:
    """Raw sales with the year and department folder each is landed in."""
    return sql.replace(
        "\nFROM lineitem", ",\n  year(l_shipdate) AS year, CAST(l_suppkey % 5 AS STRING) AS dept\nFROM lineitem"
    )


# One line per order, by priority: too short, too long, quoted with doubled quotes, with a byte that is no text (~), good.
DAMAGED = """
SELECT
  CAST(floor(o_orderkey / 50000) AS BIGINT) AS dept, o_orderkey AS place,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN CAST(o_custkey AS STRING)
    WHEN '2-HIGH' THEN concat(CAST(o_custkey AS STRING), ';', CAST(o_orderkey AS STRING), ';surplus')
    WHEN '3-MEDIUM' THEN concat(chr(34), CAST(o_custkey AS STRING), ';', chr(34), chr(34), 'x',
         chr(34), chr(34), chr(34), ';', CAST(o_orderkey AS STRING))
    WHEN '4-NOT SPECIFIED' THEN concat(CAST(o_custkey AS STRING), '~;', CAST(o_orderkey AS STRING))
    ELSE concat(CAST(o_custkey AS STRING), ';', CAST(o_orderkey AS STRING)) END AS line
FROM orders"""


# One record per order: its comment column holds line breaks, doubled quotes, separators, a quote inside a field, or nothing.
QUOTED = """
SELECT
  o_orderkey AS place,
  concat_ws(';', CAST(o_custkey AS STRING), CAST(o_orderkey AS STRING),
    CASE o_orderpriority
      WHEN '1-URGENT' THEN concat(chr(34), 'first', chr(10), chr(10), 'second', chr(34))
      WHEN '2-HIGH' THEN concat(chr(34), chr(34), chr(34), 'x', chr(34), chr(34), ';', chr(10), 'y', chr(34))
      WHEN '3-MEDIUM' THEN concat('5', chr(34), ' wide')
      WHEN '4-NOT SPECIFIED' THEN ''
      ELSE CAST(o_totalprice AS STRING) END) AS line
FROM orders
WHERE o_orderstatus <> 'P'
UNION ALL
SELECT o_orderkey AS place, CAST(o_custkey AS STRING) AS line FROM orders WHERE o_orderstatus = 'P'"""
