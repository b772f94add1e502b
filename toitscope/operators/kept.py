"""Amount counts kept beside the stored sales, from which price figures follow without reading the sales.

For each load folder of the sales they say how often sales of the same amounts occur per commune and day, and, per year,
how many sales, known amounts and cents there are of the same blocks of amounts. All measures of a sale stay in one row,
so there is at most a row for each sale; readers take them apart. A load adds the counts of its own folder; a removal
adds the counts of the rows it hides with a minus, from the rows it has found anyway; a compaction adds up the counts of
the folders it replaces. Counts of a folder that is gone are not read, and a folder without counts is counted when it is
read, so figures are those of the stored sales whether or not the counts were brought up to date.

A median is no sum of medians, but counts can be added and taken away, so it is exact here too: the block with the
middle rank is found from the block totals of whole years and the days before them, and only prices of such blocks
go on. Means and numbers need block totals alone.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.operators.commits import Snapshot, Transaction, current, in_transaction, transaction
from toitscope.operators.medians import cents
from toitscope.operators.storage import MAX_ROWS_PER_FILE, concerned, folders_of, placed_rows, read_table, staged, staging

SALES, COUNTS = "transactions", "transactions_amounts"
# The cents per block of each measure; part of what is stored. Only the mean of surfaces is asked for: one block.
BLOCKS = {"prix": 1_000_000, "prix_m2": 100_000, "surface": 10**12}
# The number of a measure in the counts is its place here. Medians are asked for of the first two.
MEASURES = list(BLOCKS)
PRICES = MEASURES[:2]
COLUMNS = ["commune_id", "date_transaction", *MEASURES]
# Sums of cents are kept as sums of millions and of the rest: no sum of whole numbers overflows, and none is a decimal.
MILLION = 1_000_000
BLOCK_KEYS = [f"{name}_block" for name in MEASURES]
FIGURES = ["n", *[f"{name}_{figure}" for name in MEASURES for figure in ("known", "high", "low")]]
FOLDERS = "counts string, grain string, folder int, year int"
# By grain. A folder of counts is ``counts=<unique>/grain=<grain>/folder=<number>/year=<yyyy>``.
SCHEMAS = {
    "day": ", ".join(["commune_id string, since date", *[f"{name} bigint" for name in [*MEASURES, "n"]], FOLDERS]),
    "year": ", ".join(["commune_id string", *[f"{name} bigint" for name in [*BLOCK_KEYS, *FIGURES]], FOLDERS]),
}
DAY_KEYS, YEAR_KEYS = ["folder", "year", "commune_id", "since", *MEASURES], ["folder", "year", "commune_id", *BLOCK_KEYS]
# So many folders at most are written from wherever their counts are found, in some files each.
FEW_FOLDERS = 8


def _sales_folder(counts: str) -> str:
    """The load folder of the sales that a folder of counts describes."""
    return unquote(counts.partition("/")[2])


def _name(counts: str, number: int, sales_folder: str) -> str:
    """How the commit lists a folder of counts: what was written together, its number there, and what it describes."""
    return f"{counts}.{number}/{sales_folder}"


def _place(name: str) -> tuple[str, int]:
    """What was written together with a folder of counts, and its number there."""
    counts, _, number = name.partition("/")[0].rpartition(".")
    return counts, int(number)


def keeps_counts(at: Snapshot | Transaction) -> bool:
    return bool(at.folders(COUNTS))


def covered(at: Snapshot | Transaction) -> tuple[list[str], list[str], list[str]]:
    """Folders of counts in use, those whose sales are gone, and load folders of the sales without counts."""
    sales = {unquote(folder): folder for folder in at.folders(SALES)}
    used = [name for name in at.folders(COUNTS) if _sales_folder(name) in sales]
    described = {_sales_folder(name) for name in used}
    unused = [name for name in at.folders(COUNTS) if _sales_folder(name) not in sales]
    return used, unused, [folder for name, folder in sales.items() if name not in described]


def _rows_of(sales: DataFrame, *more: str) -> DataFrame:
    """Sales as counts by day, each of one."""
    amounts = [cents(F.col(name)).alias(name) for name in MEASURES]
    day = F.col("date_transaction")
    return sales.select(*more, "commune_id", day.alias("since"), F.year(day).alias("year"), *amounts, F.lit(1).cast("bigint").alias("n"))


def _blocked(days: DataFrame) -> DataFrame:
    """Counts by day as block totals, each of one row."""
    columns = {}
    for name, size in BLOCKS.items():
        units, n = F.col(name), F.col("n")
        columns[f"{name}_block"] = F.coalesce(F.expr(f"{name} div {size}"), F.lit(0).cast("bigint"))
        columns[f"{name}_known"] = F.when(units.isNotNull(), n).otherwise(F.lit(0).cast("bigint"))
        columns[f"{name}_high"] = F.coalesce(F.expr(f"{name} div {MILLION}") * n, F.lit(0).cast("bigint"))
        columns[f"{name}_low"] = F.coalesce(units % MILLION * n, F.lit(0).cast("bigint"))
    return days.withColumns(columns)


def _sums(rows: DataFrame, keys: list[str], figures: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in figures])


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found


def _write(counts: DataFrame, path: str, grain: str, folders: int) -> None:
    if folders > FEW_FOLDERS:
        # Partitions of like size: Spark splits a year of one large load and joins the small ones.
        counts = counts.hint("rebalance", F.col("folder"), F.col("year"))
    order = ["folder", "year", *(["since"] if grain == "day" else []), "commune_id"]
    laid = counts.sortWithinPartitions(*order).write.partitionBy("folder", "year")
    laid.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(f"{path}/grain={grain}")


def _store(days: DataFrame, warehouse: str, sales_folders: list[str], years: DataFrame | None = None, whole: bool = True) -> list[str]:
    """Write counts by day (``DAY_KEYS`` and ``n``) and by year of load folders, of which ``folder`` is the place in the list.

    The counts by year are those that follow from the written days, unless given. Returns the names of the folders of
    counts: of all load folders if these are counted as a ``whole``, else of those with rows.
    """
    spark, counts = days.sparkSession, f"counts={uuid.uuid4().hex}"
    path = f"{warehouse}/{COUNTS}/{counts}"
    _write(days, path, "day", len(sales_folders))
    if years is None:
        written = spark.read.schema(SCHEMAS["day"]).option("basePath", f"{warehouse}/{COUNTS}").parquet(f"{path}/grain=day")
        years = _sums(_blocked(written), YEAR_KEYS, FIGURES)
    _write(years, path, "year", len(sales_folders))
    if whole:
        found = list(range(len(sales_folders)))
        for grain in SCHEMAS:
            _make_folders(spark, [f"{path}/grain={grain}/folder={number}" for number in found])
    else:
        found = sorted(int(name.partition("=")[2]) for name in folders_of(spark, f"{path}/grain=day", "folder="))
    return [_name(counts, number, sales_folders[number]) for number in found]


def _make_folders(spark: SparkSession, paths: list[str]) -> None:
    """Folders for counts that may have no rows: one that is listed and gone is an error."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def _numbered(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few rows that the driver has, small enough for Spark to send them along."""
    found = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*found)))


def _with_numbers(sales: DataFrame, folders: list[str]) -> DataFrame:
    """Sales of these load folders, in ``folder`` the place of theirs in the list."""
    parts = [unquote(folder).split("/") for folder in folders]
    rows = [(*[part.partition("=")[2] for part in found], number) for number, found in enumerate(parts)]
    return sales.join(_numbered(sales.sparkSession, rows, ["commit", "load_id", "folder"]), ["commit", "load_id"])


def _days_of(sales: DataFrame, sign: int = 1) -> DataFrame:
    counted = _rows_of(sales, "folder").groupBy(*DAY_KEYS).agg(F.count("*").alias("n"))
    return counted if sign == 1 else counted.withColumn("n", F.col("n") * sign)


def _read(spark: SparkSession, warehouse: str, names: list[str], grain: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[grain]).option("basePath", f"{warehouse}/{COUNTS}")
    places = [_place(name) for name in names]
    return reader.parquet(*[f"{warehouse}/{COUNTS}/{counts}/grain={grain}/folder={number}" for counts, number in places])


def refresh_counts(spark: SparkSession, warehouse: str) -> list[str]:
    """Count the load folders of the sales that have no counts yet; returns these folders.

    From the first call on, loads and removals keep the counts. A change of the sales by another writer is a conflict,
    after which the work is done anew.
    """

    def work() -> list[str]:
        at = current(spark, warehouse)
        at.rely_on(SALES)
        at.rely_on(COUNTS)
        _, unused, missing = covered(at)
        at.remove(COUNTS, unused)
        if not missing:
            return []
        marked = concerned(at, SALES, missing)
        whole = [folder for folder in missing if folder not in marked]
        names = [*COLUMNS, "commit", "load_id"]
        parts = [placed_rows(spark, warehouse, SALES, some, at).select(*names) for some in (whole, marked) if some]
        for name in _store(_days_of(_with_numbers(_union(parts), missing)), warehouse, missing):
            at.add(COUNTS, name)
        return missing

    return in_transaction(spark, warehouse, work)


def take_away(spark: SparkSession, warehouse: str, hidden: DataFrame) -> None:
    """Add the counts of sales that a removal hides, with a minus; ``hidden`` has ``COLUMNS``, commit and load id.

    Rows of folders without counts are left out: when these are counted, the rows are hidden already. Two removals
    may name the same row, so the counts of the second are a conflict.
    """
    with transaction(spark, warehouse) as at:
        at.rely_on(COUNTS)
        used, _, _ = covered(at)
        if not used:
            return
        counted = {_sales_folder(name) for name in used}
        folders = sorted(folder for folder in at.folders(SALES) if unquote(folder) in counted)
        rows = _with_numbers(hidden.select(*COLUMNS, "commit", "load_id"), folders)
        for name in _store(_days_of(rows, -1), warehouse, folders, whole=False):
            at.add(COUNTS, name)


def carry_over(spark: SparkSession, warehouse: str, old: list[str], new: list[str]) -> None:
    """Counts of load folders that were written anew as ``new``, from those of the ``old`` ones of the same load.

    ``new`` folders lie under one commit. A load of which a folder has no counts gets its own when it is counted next.
    """
    with staging(spark), transaction(spark, warehouse) as at:
        loads = {unquote(folder).rpartition("/")[2]: folder for folder in new}
        replaced = {unquote(folder) for folder in old}
        used = [name for name in at.folders(COUNTS) if _sales_folder(name) in replaced]
        uncounted = {folder.rpartition("/")[2] for folder in replaced - {_sales_folder(name) for name in used}}
        carried = [name for name in used if _sales_folder(name).rpartition("/")[2] in set(loads) - uncounted]
        at.remove(COUNTS, used)
        if not carried:
            return
        at.rely_on(COUNTS)
        folders = sorted({loads[_sales_folder(name).rpartition("/")[2]] for name in carried})
        numbers = {load: folders.index(folder) for load, folder in loads.items() if folder in folders}
        found = [(*_place(name), numbers[_sales_folder(name).rpartition("/")[2]]) for name in carried]
        rows = [(counts.partition("=")[2], number, new_number) for counts, number, new_number in found]
        places = _numbered(spark, rows, ["counts", "folder", "new"])
        # Only communes of which something was taken away have counts that meet; files without such rows are not opened.
        less = _read(spark, warehouse, carried, "day").where(F.col("n") < 0)
        touched = staged(less.select(F.col("commune_id").alias("_touched")).distinct(), "touched")
        meets = F.col("commune_id").eqNullSafe(F.col("_touched"))

        def summed(grain: str, keys: list[str], figures: list[str]) -> DataFrame:
            moved = _read(spark, warehouse, carried, grain).join(places, ["counts", "folder"]).drop("folder")
            moved = moved.withColumnRenamed("new", "folder").select(*keys, *figures)
            left = _sums(moved.join(touched, meets, "left_semi"), keys, figures).where(F.col("n") != 0)
            return moved.join(touched, meets, "left_anti").unionAll(left)

        for name in _store(summed("day", DAY_KEYS, ["n"]), warehouse, folders, summed("year", YEAR_KEYS, FIGURES)):
            at.add(COUNTS, name)


def _periods(since: Column | None) -> dict[str, Column]:
    """Which rows make up the time from a day on: days up to the next first of January, then years."""
    year = F.col("year")
    if since is None:
        return {"year": F.lit(True)}
    first_year = F.add_months(F.trunc(F.date_sub(since, 1), "YY"), 12)
    start = F.col("since")
    return {"day": (year == F.year(since)) & (start >= since) & (start < first_year), "year": year >= F.year(first_year)}


def _uncounted(spark: SparkSession, warehouse: str, at, missing: list[str], since: Column | None) -> DataFrame:
    """Sales of load folders without counts, as counts by day."""
    sales = read_table(spark, warehouse, SALES, missing, at)
    if since is not None:
        sales = sales.where((F.col("date_transaction") >= since) & (F.col("year") >= F.year(since)))
    return _rows_of(sales)


def read_amounts(
    spark: SparkSession, warehouse: str, keys: list[str], measures: list[str] = PRICES, since: Column | None = None
) -> DataFrame:
    """How often each price occurs (keys, measure, units, n), by ``commune_id`` and maybe ``year``, from a day on.

    A price may have several rows for each day and load, and negative ones where sales were removed. Sales themselves
    are read only in load folders without counts.
    """
    at = current(spark, warehouse)
    used, _, missing = covered(at)
    names, parts = [*keys, *measures, "n"], []
    if used:
        days = _read(spark, warehouse, used, "day")
        if since is not None:
            days = days.where((F.col("year") >= F.year(since)) & (F.col("since") >= since))
        parts.append(days.select(*names))
    if missing or not used:
        parts.append(_uncounted(spark, warehouse, at, missing, since).select(*names))
    entries = [F.struct(F.lit(MEASURES.index(name)).alias("measure"), F.col(name).alias("units")) for name in measures]
    return _union(parts).select(*keys, F.inline(F.array(*entries)), "n")


def read_sums(
    spark: SparkSession, warehouse: str, keys: list[str], since: Column | None = None, measures: list[str] = MEASURES
) -> DataFrame:
    """``block_sums`` of all stored sales, or of those from a day on, by ``commune_id`` and maybe ``year``.

    Sales themselves are read only in load folders without counts.
    """
    at = current(spark, warehouse)
    used, _, missing = covered(at)
    figures = [f"{name}_{figure}" for name in measures for figure in ("block", "known", "high", "low")]
    names, parts = [*keys, "n", *figures], []
    if used:
        for grain, period in _periods(since).items():
            found = _read(spark, warehouse, used, grain).where(period)
            parts.append((found if grain == "year" else _blocked(found)).select(*names))
    if missing or not used:
        parts.append(_blocked(_uncounted(spark, warehouse, at, missing, since)).select(*names))

    def entry(name: str) -> Column:
        columns = {"block": f"{name}_block", "nb_rows": "n", "in_block": f"{name}_known", "high": f"{name}_high", "low": f"{name}_low"}
        return F.struct(F.lit(MEASURES.index(name)).alias("measure"), *[F.col(c).alias(to) for to, c in columns.items()])

    rows = _union(parts).select(*keys, F.inline(F.array(*[entry(name) for name in measures])))
    summed = _sums(rows, [*keys, "measure", "block"], ["nb_rows", "in_block", "high", "low"])
    total = F.col("high").cast("decimal(20,0)") * F.lit(MILLION).cast("decimal(7,0)") + F.col("low")
    known = F.when(F.col("in_block") != 0, total.cast("decimal(38,0)"))
    return summed.withColumn("total", known).where("nb_rows <> 0").drop("high", "low")
