"""Every operator as a query over the driver's tables. Decimals leave as doubles for the comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import raw
from queries.tables import AS_OF, EQUIPMENT, RUNS_AS_OF, Tables
from toitscope import schemas
from toitscope.functions.labels import building_type, property_type
from toitscope.functions.measures import json_or_null, price_per_m2
from toitscope.functions.text import field
from toitscope.operators import changes, cleaning, integrity, kept, keyed, ledger, ranking, storage
from toitscope.operators.commits import transaction
from toitscope.plans import areas, energy, indicators, kept_prices, loading, prices, terms
from toitscope.plans.views import EVENTS_FOLDER
from toitscope.session import shared_folder
from toitscope.sources import landing
from toitscope.sources import tables as sql_tables
from toitscope.sources.delimited import read_delimited
from toitscope.streaming.incremental import ingest, ingest_transactions, stream_parquet

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
DEPARTMENTS = ["NATION_1", "NATION_7", "NATION_12"]
FOLDER_YEARS, FOLDER_DEPARTMENTS = [1996, 1999], ["1", "3"]
RECORDS_PER_FILE = 2_000_000


def registered(build: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Tables(spark, folder)))

    REGISTRY[build.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    def column(spec: T.StructField):
        value = F.col(f"`{spec.name}`")
        return value.cast("double").alias(spec.name) if isinstance(spec.dataType, T.DecimalType) else value

    return df.select(*[column(spec) for spec in df.schema.fields])


def day(text: str):
    return F.lit(text).cast("date")


# --- analyses -----------------------------------------------------------------------------------


@registered
def price_stats_commune(t: Tables) -> DataFrame:
    return prices.price_stats(t.sales(), t.communes(), day(AS_OF))


@registered
def energy_stats_commune(t: Tables) -> DataFrame:
    return energy.energy_stats(t.diagnoses(), t.communes())


@registered
def dept_price_top10(t: Tables) -> DataFrame:
    return prices.busiest_departments(t.sales(), t.communes(), 10)


@registered
def stats_by_level(t: Tables) -> DataFrame:
    return areas.stats_by_level(t.sales(), t.communes())


@registered
def price_yoy(t: Tables) -> DataFrame:
    return areas.yearly_prices(t.sales(), t.communes(), "dept")


@registered
def area_vs_parent(t: Tables) -> DataFrame:
    return areas.area_against_parent(t.sales(), t.communes())


@registered
def affordability_indicators(t: Tables) -> DataFrame:
    return indicators.affordability(t.sales(), t.demographics())


@registered
def equipment_by_commune(t: Tables) -> DataFrame:
    return indicators.equipment_counts(t.infrastructure())


@registered
def equipment_pivot(t: Tables) -> DataFrame:
    return indicators.equipment_table(t.infrastructure(), EQUIPMENT)


@registered
def term_counts(t: Tables) -> DataFrame:
    return terms.term_counts(t.documents, "lang", "text")


@registered
def top_terms(t: Tables) -> DataFrame:
    return terms.top_terms(t.documents, "lang", "text", 50)


# --- run history --------------------------------------------------------------------------------


@registered
def latest_run_per_loader(t: Tables) -> DataFrame:
    return ledger.latest_runs(t.runs())


@registered
def loader_success_stats(t: Tables) -> DataFrame:
    return ledger.loader_success(t.runs())


@registered
def recent_runs_top10(t: Tables) -> DataFrame:
    return ledger.recent_runs(t.runs(), 10)


@registered
def runs_last_7_days(t: Tables) -> DataFrame:
    return ledger.runs_since(t.runs(), F.lit(RUNS_AS_OF).cast("timestamp_ntz"), 7)


@registered
def run_durations(t: Tables) -> DataFrame:
    return t.runs().select("id", ledger.duration())


@registered
def load_success_ratio(t: Tables) -> DataFrame:
    return ledger.success_ratio(t.runs())


@registered
def success_ratio_per_run(t: Tables) -> DataFrame:
    """Every user's events as the loads of one pipeline run."""
    return ledger.success_ratio_per_run(t.runs().join(t.events.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("pipeline_id")), "id"))


@registered
def run_ledger_fold(t: Tables) -> DataFrame:
    """Each run as the events its load would have appended, folded back."""
    runs = t.runs()
    none = F.lit(None)
    opening = runs.select(
        F.col("id").alias("run_id"),
        "scraper_name",
        F.lit("running").alias("status"),
        F.col("started_at").alias("at"),
        none.cast("bigint").alias("records_processed"),
        none.cast("bigint").alias("table_total"),
        none.cast("string").alias("error_message"),
        "metadata",
        none.cast("string").alias("pipeline_id"),
    )
    failed = F.col("status") == "failed"
    closing = runs.where(F.col("status") != "running").select(
        F.col("id").alias("run_id"),
        "scraper_name",
        "status",
        F.col("completed_at").alias("at"),
        F.when(~failed, F.col("records_processed")).alias("records_processed"),
        none.cast("bigint").alias("table_total"),
        F.when(failed, F.concat(F.lit("error in "), F.col("scraper_name"))).alias("error_message"),
        none.cast("string").alias("metadata"),
        none.cast("string").alias("pipeline_id"),
    )
    return ledger.fold_runs(opening.unionByName(closing)).drop("table_total", "pipeline_id")


@registered
def metadata_json_roundtrip(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    text = json_or_null(department=F.when(k < 90, F.col("event_type")), year=F.when(k < 80, F.year("ts")))
    return t.events.select("event_id", text.alias("metadata")).select(
        "event_id",
        F.get_json_object("metadata", "$.department").alias("department"),
        F.get_json_object("metadata", "$.year").cast("int").alias("year"),
        F.col("metadata").isNull().alias("no_metadata"),
    )


# --- cleaning -----------------------------------------------------------------------------------


@registered
def clean_transactions(t: Tables) -> DataFrame:
    cleaned = cleaning.clean_transactions(t.raw(raw.TRANSACTIONS, "lineitem"))
    return integrity.narrow(cleaned, "transactions")


@registered
def clean_dpe(t: Tables) -> DataFrame:
    return integrity.narrow(cleaning.clean_dpe(t.raw(raw.DPE, "lineitem", "part")), "dpe")


@registered
def clean_communes(t: Tables) -> DataFrame:
    return integrity.narrow(cleaning.clean_communes(t.raw(raw.COMMUNES, "orders")), "communes")


@registered
def clean_population(t: Tables) -> DataFrame:
    return cleaning.clean_population(t.raw(raw.POPULATION, "orders"), 2021)


@registered
def clean_income(t: Tables) -> DataFrame:
    return cleaning.clean_income(t.raw(raw.INCOME, "part"))


@registered
def merge_demographics(t: Tables) -> DataFrame:
    population = cleaning.clean_population(t.raw(raw.POPULATION, "orders"), 2021)
    income = cleaning.clean_income(t.raw(raw.INCOME, "part"))
    return integrity.narrow(cleaning.merge_demographics(population, income, 2021), "demographics")


@registered
def rejected_transactions(t: Tables) -> DataFrame:
    screened = cleaning.screen_transactions(t.raw(raw.TRANSACTIONS, "lineitem"))
    return screened.groupBy(F.coalesce("_reject", F.lit("loaded")).alias("reason")).agg(
        F.count("*").alias("nb_rows")
    )


@registered
def map_type_bien(t: Tables) -> DataFrame:
    rows = t.raw(raw.TRANSACTIONS, "lineitem").select(field(F.col("type_local")).alias("label"))
    return rows.groupBy("label", property_type(F.col("label")).alias("type_bien")).agg(F.count("*").alias("nb"))


@registered
def map_type_batiment(t: Tables) -> DataFrame:
    rows = t.raw(raw.DPE, "lineitem", "part").select(field(F.col("`Type_bâtiment`")).alias("label"))
    return rows.groupBy("label", building_type(F.col("label")).alias("type_batiment")).agg(
        F.count("*").alias("nb")
    )


@registered
def price_per_square_metre(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
        price_per_m2(F.col("l_extendedprice"), F.col("l_quantity")).alias("prix_m2"),
    )


# --- sources ------------------------------------------------------------------------------------


def landed(t: Tables, source: schemas.Source, sql: str, *names: str) -> DataFrame:
    """The raw text written as delimited files in the shared folder and read back by the source reader."""
    path = f"{shared_folder(t.spark)}/landing/{source.name}-{uuid.uuid4().hex}"
    text = t.raw(sql, *names)
    if "_pos" in text.columns:
        text = text.withColumnRenamed("_pos", "place")
    text.write.options(
        header=True, sep=source.separator, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    if "place" in text.columns:
        source = schemas.Source(source.name, source.separator, source.columns, source.required, ["place"])
    return read_delimited(t.spark, path, source)


@registered
def transactions_from_csv(t: Tables) -> DataFrame:
    scanned = landed(t, schemas.TRANSACTIONS_SOURCE, raw.TRANSACTIONS, "lineitem")
    return integrity.narrow(cleaning.clean_transactions(scanned), "transactions")


@registered
def dpe_from_csv(t: Tables) -> DataFrame:
    scanned = landed(t, schemas.DPE_SOURCE, raw.DPE, "lineitem", "part")
    return integrity.narrow(cleaning.clean_dpe(scanned), "dpe")


@registered
def communes_from_csv(t: Tables) -> DataFrame:
    scanned = landed(t, schemas.COMMUNES_SOURCE, raw.COMMUNES, "orders")
    return integrity.narrow(cleaning.clean_communes(scanned), "communes")


def _placed(scanned: DataFrame) -> DataFrame:
    """The test files are written by several tasks: their own place column tells the order."""
    return scanned.withColumn("_pos", F.col("place").cast("bigint")).drop("place")


@registered
def population_from_csv(t: Tables) -> DataFrame:
    scanned = landed(t, schemas.POPULATION_SOURCE, raw.POPULATION, "orders")
    return cleaning.clean_population(_placed(scanned), 2021)


@registered
def income_from_csv(t: Tables) -> DataFrame:
    return cleaning.clean_income(_placed(landed(t, schemas.INCOME_SOURCE, raw.INCOME, "part")))


EXACT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
YEAR = 2001


def land_register(t: Tables, root: str) -> None:
    register = t.communes().select(
        F.col("code_insee").alias("com_code"),
        F.col("nom").alias("com_nom"),
        # Departments of the stand-in are longer than a code may be: keep what follows the underscore.
        F.substring_index("dept", "_", -1).alias("dep_code"),
        F.col("region").alias("reg_nom"),
        F.lit("46.5").alias("latitude"),
        F.lit("").alias("longitude"),
    )
    register.write.options(**EXACT).csv(f"{root}/in/communes")


def land_sales(t: Tables, root: str) -> None:
    sales = t.raw(raw.TRANSACTIONS, "lineitem")
    sales.write.options(**EXACT, sep="|").csv(f"{root}/in/transactions/year={YEAR}/dept=all")


def land_figures(t: Tables, root: str) -> None:
    """Population and income as files whose order is that of their rows."""
    for name, sql, table in (("population", raw.POPULATION, "orders"), ("income", raw.INCOME, "part")):
        rows = t.raw(sql, table).repartitionByRange("_pos").sortWithinPartitions("_pos").drop("_pos")
        rows.write.options(**EXACT, sep=";").csv(f"{root}/in/{name}")


def land_diagnoses(t: Tables, root: str) -> None:
    t.raw(raw.DPE, "lineitem", "part").write.options(**EXACT).csv(f"{root}/in/dpe/dept=all")


def fresh(t: Tables) -> tuple[str, str, str]:
    root = f"{shared_folder(t.spark)}/load-{uuid.uuid4().hex}"
    return root, f"{root}/in", f"{root}/warehouse"


def loaded(t: Tables) -> str:
    """Register and sales landed as files and loaded into a fresh warehouse."""
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    land_sales(t, root)
    loading.load_communes(t.spark, landing_root, warehouse)
    loading.load_transactions(t.spark, landing_root, warehouse, [YEAR])
    return warehouse


def all_loaded(t: Tables) -> str:
    """All sources landed as files and loaded by one pipeline run."""
    root, landing_root, warehouse = fresh(t)
    for land in (land_register, land_sales, land_figures, land_diagnoses):
        land(t, root)
    loading.load_all(t.spark, landing_root, warehouse, YEAR)
    return warehouse


@registered
def stored_transactions(t: Tables) -> DataFrame:
    """Files to stored sales: parsed, checked against rules and register, appended, read back."""
    return storage.read_table(t.spark, loaded(t), "transactions").drop("created_at")


@registered
def streamed_transactions(t: Tables) -> DataFrame:
    """The same sales in two deliveries, each streamed once, and a third run that finds nothing new."""
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    loading.load_communes(t.spark, landing_root, warehouse)
    sales = t.raw(raw.TRANSACTIONS, "lineitem")
    first = F.col("code_postal") < "00050"
    for number, some in enumerate((sales.where(first), sales.where(~first), None)):
        if some is not None:
            some.write.options(**EXACT, sep="|").csv(f"{root}/drops/delivery-{number}")
        ingest_transactions(t.spark, f"{root}/drops", warehouse, f"{root}/checkpoint")
    return storage.read_table(t.spark, warehouse, "transactions").drop("created_at")


@registered
def streamed_redelivery(t: Tables) -> DataFrame:
    """A part of the sales streamed first, then all of them from another folder, and the same files once more."""
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    loading.load_communes(t.spark, landing_root, warehouse)
    sales = t.raw(raw.TRANSACTIONS, "lineitem")
    for number, some in enumerate((sales.where(F.col("code_postal") < "00050"), sales, sales)):
        some.write.options(**EXACT, sep="|").csv(f"{root}/drops/delivery-{number}")
        ingest_transactions(t.spark, f"{root}/drops", warehouse, f"{root}/checkpoint", only_new=True)
    return storage.read_table(t.spark, warehouse, "transactions").drop("created_at")


@registered
def snapshot_load(t: Tables) -> DataFrame:
    """Two writers: while one rewrites the stored sales into fewer files, the other adds the rest of them."""
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    sales = t.raw(raw.TRANSACTIONS, "lineitem")
    first = F.col("code_postal") < "00050"
    for number, some in enumerate((sales.where(first), sales.where(~first))):
        some.write.options(**EXACT, sep="|").csv(f"{root}/in-{number}/transactions/year={YEAR}/dept=all")
    loading.load_communes(t.spark, landing_root, warehouse)
    loading.load_transactions(t.spark, f"{root}/in-0", warehouse, [YEAR])
    with transaction(t.spark, warehouse):
        storage.replace(storage.read_table(t.spark, warehouse, "transactions").drop("year"), warehouse, "transactions")
        other = InheritableThread(target=loading.load_transactions, args=(t.spark, f"{root}/in-1", warehouse, [YEAR]))
        other.start()
        other.join()
    return storage.read_table(t.spark, warehouse, "transactions").drop("created_at")


def _around_compaction(t: Tables, warehouse: str, table: str) -> DataFrame:
    """Rows of a table as marks leave them, and as compaction does."""
    marked = storage.read_table(t.spark, warehouse, table).withColumn("compacted", F.lit(False))
    changes.compact(t.spark, warehouse, table)
    return marked.unionAll(storage.read_table(t.spark, warehouse, table).withColumn("compacted", F.lit(True)))


@registered
def cascade_by_bitmap(t: Tables) -> DataFrame:
    """Stored sales once the communes with a negative balance are gone from the register."""
    warehouse = loaded(t)
    deleted = t.supplier.where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").cast("string").alias("code_insee"))
    loading.remove_communes(t.spark, warehouse, deleted)
    return _around_compaction(t, warehouse, "transactions").drop("created_at")


@registered
def upsert_by_delta(t: Tables) -> DataFrame:
    """The register of ``upsert_communes``, stored, with a delivery merged into it."""
    _, _, warehouse = fresh(t)
    storage.append(integrity.narrow(_register(t), "communes"), warehouse, "communes")
    incoming = integrity.narrow(cleaning.fold_communes(t.raw(raw.COMMUNES, "orders")), "communes")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    fill = {"created_at": now, "updated_at": now}
    changes.merge_rows(incoming, warehouse, "communes", loading.COMMUNE_UPDATES, fill)
    return _around_compaction(t, warehouse, "communes")


def with_kept_counts(t: Tables) -> str:
    """Three loads of sales and then a removal of communes, with counts kept beside the sales all along."""
    _, _, warehouse = fresh(t)
    storage.append(storage.with_defaults(integrity.narrow(t.communes(), "communes"), "communes"), warehouse, "communes")
    sales, line = t.sales(), F.col("l_linenumber")
    numbered = t.sales(line)
    for load, some in {"first": line < 3, "second": line.between(3, 4), "third": line > 4}.items():
        part = numbered.where(some).select(*sales.columns)
        storage.append(storage.with_defaults(part, "transactions"), warehouse, "transactions", load)
        kept.refresh_counts(t.spark, warehouse)
    deleted = t.supplier.where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").cast("string").alias("code_insee"))
    loading.remove_communes(t.spark, warehouse, deleted)
    return warehouse


@registered
def kept_price_stats(t: Tables) -> DataFrame:
    """``price_stats_commune`` without reading the stored sales, once some communes are gone."""
    return kept_prices.kept_price_stats(t.spark, with_kept_counts(t), day(AS_OF))


@registered
def kept_stats_by_level(t: Tables) -> DataFrame:
    """``stats_by_level`` without reading the stored sales, from counts that a compaction has carried over."""
    warehouse = with_kept_counts(t)
    changes.compact(t.spark, warehouse, "transactions")
    return kept_prices.kept_stats_by_level(t.spark, warehouse)


@registered
def kept_price_yoy(t: Tables) -> DataFrame:
    """``price_yoy`` without reading the stored sales."""
    return kept_prices.kept_yearly_prices(t.spark, with_kept_counts(t), "dept")


@registered
def stored_dpe(t: Tables) -> DataFrame:
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    land_diagnoses(t, root)
    loading.load_communes(t.spark, landing_root, warehouse)
    loading.load_dpe(t.spark, landing_root, warehouse)
    return storage.read_table(t.spark, warehouse, "dpe").drop("created_at")


@registered
def stored_demographics(t: Tables) -> DataFrame:
    root, landing_root, warehouse = fresh(t)
    land_register(t, root)
    land_figures(t, root)
    loading.load_communes(t.spark, landing_root, warehouse)
    loading.load_demographics(t.spark, landing_root, warehouse, YEAR)
    return storage.read_table(t.spark, warehouse, "demographics").drop("created_at", "updated_at")


@registered
def quarantined_transactions(t: Tables) -> DataFrame:
    rows = loading.read_quarantine(t.spark, loaded(t)).where(F.col("table_name") == "transactions")
    return integrity.violation_counts(rows)


@registered
def quarantined_rows(t: Tables) -> DataFrame:
    """Reasons by source over all loads."""
    rows = loading.read_quarantine(t.spark, all_loaded(t))
    return (
        rows.select("source", F.explode("violations").alias("violation"))
        .groupBy("source", "violation")
        .agg(F.count("*").alias("nb_rows"))
    )


@registered
def load_ledger(t: Tables) -> DataFrame:
    """What the ledger says of a run of all loads, clocks and ids left out."""
    runs = ledger.fold_runs(ledger.read_events(t.spark, f"{all_loaded(t)}/{EVENTS_FOLDER}"))
    in_order = (F.col("completed_at") > F.col("started_at")) & F.col("pipeline_id").isNotNull()
    return runs.select("scraper_name", "status", "records_processed", "table_total", in_order.alias("closed"))


@registered
def dpe_by_department(t: Tables) -> DataFrame:
    """All diagnoses of communes that the register places in one of several departments."""
    chosen = loading.of_departments(t.raw(raw.DPE, "lineitem", "part"), t.communes(), DEPARTMENTS)
    return integrity.narrow(cleaning.clean_dpe(chosen), "dpe")


@registered
def folder_choice(t: Tables) -> DataFrame:
    """Sales landed in folders by year and department, of which some years and departments are read."""
    root = f"{shared_folder(t.spark)}/folders-{uuid.uuid4().hex}"
    rows = t.raw(raw.placed(raw.TRANSACTIONS), "lineitem")
    rows.write.partitionBy("year", "dept").options(**EXACT, sep="|").csv(f"{root}/transactions")
    chosen = landing.read_transactions(t.spark, root, FOLDER_YEARS, FOLDER_DEPARTMENTS)
    return integrity.narrow(cleaning.clean_transactions(chosen), "transactions")


@registered
def damaged_rows(t: Tables) -> DataFrame:
    """Files with short, long, quoted and undecodable rows, row by row as the reader sees them."""
    path = f"{shared_folder(t.spark)}/damaged-{uuid.uuid4().hex}"
    lines = t.raw(raw.DAMAGED, "orders")
    # Byte E9 alone is no UTF-8; it stands where the SQL says so.
    broken = F.expr("cast(concat(cast(split_part(line, '~', 1) AS BINARY), X'E9', cast(split_part(line, '~', 2) AS BINARY)) AS STRING)")
    lines = lines.withColumn("line", F.when(F.col("line").contains("~"), broken).otherwise(F.col("line")))
    # A file for every 50,000 rows; its header is its first line.
    heads = lines.select("dept").distinct().select("dept", F.lit(-1).cast("bigint").alias("place"), F.lit("COM;PMUN").alias("line"))
    files = lines.unionByName(heads).repartition("dept").sortWithinPartitions("dept", "place")
    files.select("dept", "line").write.partitionBy("dept").text(path)
    rows = read_delimited(t.spark, path, schemas.POPULATION_SOURCE)
    whole = F.col("_damage").isNull()
    return rows.select(
        F.coalesce("_damage", F.lit("whole")).alias("state"), F.when(whole, F.col("COM")).alias("com"), F.when(whole, F.col("PMUN")).alias("pmun")
    )


@registered
def multiline_csv(t: Tables) -> DataFrame:
    """Records with line breaks in quotes, some of them short, from files that several tasks read in splits."""
    path = f"{shared_folder(t.spark)}/quoted-{uuid.uuid4().hex}"
    rows = t.raw(raw.QUOTED, "orders")
    # A task writes a file, so there are more files, not larger ones, of a larger table.
    number = max(4, -(-rows.count() // RECORDS_PER_FILE))
    heads = t.spark.range(number).select((-1 - F.col("id")).alias("place"), F.lit("COM;PMUN;note").alias("line"), F.col("id").alias("dept"))
    files = rows.withColumn("dept", F.pmod("place", F.lit(number))).unionByName(heads)
    files.repartition("dept").sortWithinPartitions("dept", "place").select("dept", "line").write.partitionBy("dept").text(path)
    source = replace(schemas.POPULATION_SOURCE, optional=["note"])
    return read_delimited(t.spark, path, source, quoted_breaks=True).select("COM", "PMUN", "note", "_damage")


@registered
def dept_union_load(t: Tables) -> DataFrame:
    register = t.communes().select(F.col("code_insee").alias("commune_id"), "dept")
    wanted = register.where(landing.chosen(departments=DEPARTMENTS))
    return t.sales().join(wanted, "commune_id").select("commune_id", "dept", "date_transaction", "prix", "surface")


@registered
def table_counts(t: Tables) -> DataFrame:
    names = (
        "region nation customer supplier part orders lineitem events "
        "documents embeddings pages benchmark labels conversations"
    )
    return sql_tables.table_counts({name: getattr(t, name) for name in names.split()})


@registered
def param_query(t: Tables) -> DataFrame:
    return sql_tables.query(
        t.spark,
        "SELECT event_type, count(*) AS nb, max(value) AS max_value FROM events "
        "WHERE value >= :low AND event_type <> :other GROUP BY event_type",
        {"low": 5.0, "other": "signup"},
        events=t.events,
    )


# --- keyed loading and integrity ----------------------------------------------------------------


def _register(t: Tables) -> DataFrame:
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return t.communes().select(
        "*",
        F.lit(None).cast("decimal(10,7)").alias("latitude"),
        F.lit(None).cast("decimal(10,7)").alias("longitude"),
        F.col("code_insee").cast("int").alias("population_actuelle"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


@registered
def upsert_communes(t: Tables) -> DataFrame:
    incoming = integrity.narrow(cleaning.fold_communes(t.raw(raw.COMMUNES, "orders")), "communes")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return keyed.upsert(
        _register(t),
        incoming,
        ["code_insee"],
        ["nom", "dept", "region", "latitude", "longitude"],
        {"created_at": now, "updated_at": now},
    )


@registered
def last_value_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("last_price"),
        "o_orderpriority",
    )
    return ranking.latest_per_key(rows, ["o_custkey"], F.col("o_orderkey"))


def _child(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("commune_id"), "o_orderkey", "o_orderdate", "o_totalprice")


@registered
def fk_loadable(t: Tables) -> DataFrame:
    return integrity.loadable(_child(t), t.supplier, "commune_id", "s_suppkey")


@registered
def fk_orphans(t: Tables) -> DataFrame:
    return integrity.orphans(_child(t), t.supplier, "commune_id", "s_suppkey")


@registered
def cascade_delete(t: Tables) -> DataFrame:
    deleted = t.supplier.where(F.col("s_acctbal") < 0)
    return integrity.cascade_delete(t.sales(), deleted, "commune_id", "s_suppkey")


def _yearly_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("commune_id"),
        F.year("o_orderdate").alias("annee"),
        F.col("o_orderkey").cast("int").alias("population"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("revenu_median"),
    )


KEY = ["commune_id", "annee"]


@registered
def unique_conflicts(t: Tables) -> DataFrame:
    return keyed.key_conflicts(t.demographics(), _yearly_orders(t), KEY)


@registered
def insert_skip_conflicts(t: Tables) -> DataFrame:
    return keyed.insert_unique(t.demographics(), _yearly_orders(t), KEY, "skip", F.col("population"))


@registered
def insert_update_conflicts(t: Tables) -> DataFrame:
    return keyed.insert_unique(t.demographics(), _yearly_orders(t), KEY, "update", F.col("population"))


@registered
def demographics_update(t: Tables) -> DataFrame:
    """A later delivery that lacks some figures: stored ones stay where it has none."""
    incoming = ranking.latest_per_key(_yearly_orders(t), KEY, F.col("population"))
    partial = incoming.withColumn("revenu_median", F.when(F.col("population") % 3 > 0, F.col("revenu_median")))
    partial = partial.withColumn("population", F.when(F.col("population") % 5 > 0, F.col("population")))
    stored = t.demographics().withColumn("updated_at", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return keyed.upsert(stored, partial, KEY, ["population", "revenu_median"], keep_missing=True, touch={"updated_at": now})


@registered
def key_union(t: Tables) -> DataFrame:
    customers = t.orders.select(F.col("o_custkey").alias("code"))
    suppliers = t.lineitem.select(F.col("l_partkey").alias("code"))
    return cleaning.key_union(customers, suppliers, "code")


def _suspect_sales(t: Tables) -> DataFrame:
    """Sales of which some break a rule of the target: lengths, ranges, missing values."""
    return t.lineitem.select(
        F.col("l_orderkey"),
        F.when(F.col("l_linenumber") == 7, F.lit("123456"))
        .when(F.col("l_linenumber") > 1, F.col("l_suppkey").cast("string"))
        .alias("commune_id"),
        F.col("l_shipdate").cast("date").alias("date_transaction"),
        F.when(F.col("l_tax") == 0.08, F.lit(1e10)).otherwise(F.col("l_extendedprice")).alias("prix"),
        (F.col("l_quantity") * F.when(F.col("l_discount") == 0.1, 1e8).otherwise(1.0)).alias("surface"),
        F.when(F.col("l_returnflag") == "R", F.repeat(F.lit("x"), 51)).otherwise("maison").alias("type_bien"),
    )


@registered
def rule_violations(t: Tables) -> DataFrame:
    checked = integrity.with_violations(_suspect_sales(t), "transactions")
    return checked.select("l_orderkey", F.explode("violations").alias("violation"))


@registered
def quarantine_counts(t: Tables) -> DataFrame:
    return integrity.violation_counts(integrity.with_violations(_suspect_sales(t), "transactions"))


@registered
def append_with_defaults(t: Tables) -> DataFrame:
    equipment = t.infrastructure().select(
        "commune_id", "type_equipement", F.when(F.col("nombre") > 25, F.col("nombre")).alias("nombre")
    )
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return storage.with_defaults(equipment, "infrastructure", now)


@registered
def redelivered_rows(t: Tables) -> DataFrame:
    """A full delivery (line items) against what is stored (the returned ones): what is left to load."""
    columns = ["l_suppkey", "l_quantity", "l_returnflag"]
    stored = t.lineitem.where(F.col("l_returnflag") == "R").select(*columns)
    return keyed.not_yet_loaded(t.lineitem.select(*columns), stored, columns)


@registered
def incremental_ingest(t: Tables) -> DataFrame:
    """Orders as a landed file: streamed once into a fresh target, and again, which must add nothing."""
    run = f"{shared_folder(t.spark)}/incremental-{uuid.uuid4().hex}"
    schema = t.orders.schema

    def prepare(batch: DataFrame) -> DataFrame:
        return batch.select(
            "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("prix"), "o_orderdate"
        )

    for _ in range(2):
        stream = stream_parquet(t.spark, t.folder, schema, glob="orders.parquet")
        ingest(stream, f"{run}/orders", prepare, f"{run}/checkpoint")
    return t.spark.read.parquet(f"{run}/orders").select("o_orderkey", "o_custkey", "prix", "o_orderdate")
