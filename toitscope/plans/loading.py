"""The load: four sources into the warehouse, parents first, every run in the ledger.

Each load parses its files once into a staged Parquet table under the shared folder, with the reasons beside
each row that cannot be loaded; what it counts is observed while that table is written. Aborting, appending and
quarantining read the staged rows, so a lost executor costs a re-read of them and never a second parse, and they go
when the load ends. Rejected rows are written after the target has taken the others, under the id of the load: a
load that fails leaves neither, and one that is repeated under its id leaves both once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import wraps
from inspect import signature

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from toitscope.functions.text import field as text_field
from toitscope.operators.cleaning import (
    merge_demographics,
    screen_communes,
    screen_dpe,
    screen_income,
    screen_population,
    screen_transactions,
)
from toitscope.operators.changes import merge_rows, remove_rows
from toitscope.operators.commits import CommitConflict, after_commit, current, in_transaction, transaction
from toitscope.operators.deliveries import new_sales
from toitscope.operators.integrity import mark_orphans, narrow, with_violations
from toitscope.operators.kept import keeps_counts, refresh_counts
from toitscope.operators.keyed import insert_unique
from toitscope.operators.ledger import FAILED, SUCCESS, log_event, start_run
from toitscope.operators.ranking import latest_per_key
from toitscope.operators.storage import append, read_table, staged, staging, with_defaults
from toitscope.plans.views import EVENTS_FOLDER
from toitscope.schemas import CHILD_TABLES, UNIQUE_KEYS
from toitscope.sources import landing

ORPHAN = "commune_unknown"
# Columns a register row takes over from a new delivery.
COMMUNE_UPDATES = ["nom", "dept", "region", "latitude", "longitude"]
# Columns that the sources of demographics deliver.
DEMOGRAPHIC_FIGURES = ["population", "revenu_median"]


class LoadFailed(RuntimeError):
    """One of several loads that belong together failed."""


class RowsRejected(ValueError):
    """An ``abort`` load met rows that break a rule; nothing was written to the target."""


@dataclass
class LoadResult:
    rows_written: int = 0
    rows_rejected: int = 0
    reasons: dict[str, int] = field(default_factory=dict)

    def __add__(self, other: LoadResult) -> LoadResult:
        reasons = dict(self.reasons)
        for code, number in other.reasons.items():
            reasons[code] = reasons.get(code, 0) + number
        return LoadResult(
            self.rows_written + other.rows_written, self.rows_rejected + other.rows_rejected, reasons
        )


def judged(screened: DataFrame, table: str, communes: DataFrame | None = None) -> DataFrame:
    """Adds ``violations``: the cleaner's reason, else the broken table rules and a missing commune."""
    checked = with_violations(screened, table)
    broken = F.col("violations")
    if communes is not None:
        checked = mark_orphans(checked, communes, "commune_id", "code_insee")
        broken = F.concat(broken, F.when(F.col("_orphan"), F.array(F.lit(ORPHAN))).otherwise(F.array()))
    if "_reject" in screened.columns:
        broken = F.when(F.col("_reject").isNotNull(), F.array("_reject")).otherwise(broken)
    return checked.withColumn("violations", broken).drop("_reject", "_orphan")


@dataclass
class Settled:
    """Staged rows of one source: the good ones, what became of all, and the rejects until they are set aside."""

    good: DataFrame
    result: LoadResult
    rejects: DataFrame
    name: str

    def quarantine(self, warehouse: str, load_id: str) -> None:
        """Set the rejects aside as soon as the load is committed."""
        if self.result.rows_rejected:
            folder = f"{warehouse}/quarantine/load_id={load_id}/source={self.name}"
            rows = self.rejects.withColumn("rejected_at", F.localtimestamp())
            after_commit(rows.sparkSession, warehouse, lambda: rows.write.mode("overwrite").parquet(folder))


def settle(checked: DataFrame, table: str, on_violation: str = "quarantine", name: str | None = None) -> Settled:
    """Stage judged rows, counting them as they are written.

    With ``abort`` a row that breaks a rule stops the load before it writes.
    """
    seen = Observation()
    is_good = F.size("violations") == 0
    marked = checked.withColumn("good", is_good.cast("string")).observe(
        seen, F.count_if(is_good).alias("good"), F.count_if(~is_good).alias("bad")
    )
    rows = staged(marked, name or table, "good")
    counts = seen.get
    bad = rows.where(F.col("good") == "false")
    reasons = {}
    if counts["bad"]:
        # One row per rule: the driver receives no more than the rule set holds.
        per_rule = bad.select(F.explode("violations").alias("code")).groupBy("code").count()
        reasons = {row["code"]: row["count"] for row in per_rule.collect()}
    result = LoadResult(counts["good"], counts["bad"], reasons)
    if result.rows_rejected and on_violation == "abort":
        raise RowsRejected(f"{table}: {result.rows_rejected} rows rejected, {result.reasons}")
    values = [column for column in checked.columns if column != "violations"]
    rejects = bad.select(F.lit(table).alias("table_name"), F.to_json(F.struct(*values)).alias("row"), "violations")
    return Settled(rows.where(F.col("good") == "true").drop("violations", "good"), result, rejects, name or table)


def read_quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rejected rows of every load, with the ``load_id`` and the ``source`` they came by."""
    return spark.read.option("basePath", f"{warehouse}/quarantine").parquet(f"{warehouse}/quarantine")


def in_staging(load: Callable) -> Callable:
    """Gives a load its staging folder, its id unless the caller has one, and one transaction for all it writes.

    A load that another writer has overtaken is done anew on the state that one left.
    """
    place = list(signature(load).parameters).index("warehouse") - 1

    @wraps(load)
    def run(spark: SparkSession, *args, load_id: str | None = None, **options):
        warehouse = options["warehouse"] if "warehouse" in options else args[place]
        own = load_id or uuid.uuid4().hex

        with staging(spark):
            return in_transaction(spark, warehouse, lambda: load(spark, *args, load_id=own, **options))

    return run


def known_communes(spark: SparkSession, warehouse: str) -> DataFrame:
    """The register that rows are judged by; a load fails to commit if it has changed since."""
    current(spark, warehouse).rely_on("communes")
    return read_table(spark, warehouse, "communes")


@in_staging
def load_communes(
    spark: SparkSession,
    root: str,
    warehouse: str,
    on_violation: str = "quarantine",
    load_id: str = "",
    quoted_breaks: bool = False,
) -> LoadResult:
    """Upsert the register. The last good row of a code wins; stored stamps and population are kept."""
    found = settle(judged(screen_communes(landing.read_communes(spark, root, quoted_breaks=quoted_breaks)), "communes"), "communes", on_violation)
    incoming = narrow(latest_per_key(found.good, ["code_insee"], F.col("_pos")), "communes")
    now = F.localtimestamp()
    merge_rows(incoming, warehouse, "communes", COMMUNE_UPDATES, {"created_at": now, "updated_at": now})
    found.quarantine(warehouse, load_id)
    return found.result


@in_staging
def load_transactions(
    spark: SparkSession,
    root: str,
    warehouse: str,
    years: list[int] | None = None,
    departments: list[str] | None = None,
    separator: str | None = None,
    only_new: bool = False,
    on_violation: str = "quarantine",
    load_id: str = "",
    quoted_breaks: bool = False,
) -> LoadResult:
    """Append sales. ``only_new`` leaves out rows that earlier loads brought in."""
    raw = landing.read_transactions(spark, root, years, departments, separator, quoted_breaks=quoted_breaks)
    return store_transactions(raw, warehouse, only_new, on_violation, load_id)


def store_transactions(
    raw: DataFrame, warehouse: str, only_new: bool, on_violation: str, load_id: str
) -> LoadResult:
    """Judge landed sales, append the good ones and set the others aside, under one load id."""
    spark = raw.sparkSession
    screened = screen_transactions(raw).drop("_pos")
    found = settle(
        judged(screened, "transactions", known_communes(spark, warehouse)), "transactions", on_violation
    )
    batch, result = narrow(found.good, "transactions"), found.result
    if only_new:
        counted = Observation()
        batch = staged(new_sales(batch, warehouse, load_id).observe(counted, F.count(F.lit(1)).alias("n")), "transactions-new")
        result.rows_written = counted.get["n"]
    append(with_defaults(batch, "transactions"), warehouse, "transactions", load_id)
    found.quarantine(warehouse, load_id)
    if keeps_counts(current(spark, warehouse)):
        after_commit(spark, warehouse, lambda: count_new_sales(spark, warehouse))
    return result


def count_new_sales(spark: SparkSession, warehouse: str) -> None:
    """Bring the kept counts up to date after a load; the load stands whether or not other writers leave time for it."""
    try:
        refresh_counts(spark, warehouse)
    except CommitConflict:
        # Readers count the folder themselves until the next refresh.
        pass


@in_staging
def load_demographics(
    spark: SparkSession,
    root: str,
    warehouse: str,
    year: int,
    on_conflict: str = "abort",
    on_violation: str = "quarantine",
    load_id: str = "",
    quoted_breaks: bool = False,
) -> LoadResult:
    """Merge population and income of one year and add them under the (commune, year) key.

    ``update`` replaces the figures a delivery brings and leaves those it does not, and all others, as stored.
    """
    sources = {
        "population": screen_population(landing.read_population(spark, root, quoted_breaks=quoted_breaks)),
        "income": screen_income(landing.read_income(spark, root, quoted_breaks=quoted_breaks)),
    }
    parts = [settle(judged(rows, "demographics"), "demographics", on_violation, name) for name, rows in sources.items()]
    merged = merge_demographics(*[latest_per_key(part.good, ["commune_id"], F.col("_pos")) for part in parts], year)
    checked = judged(merged, "demographics", known_communes(spark, warehouse))
    found = settle(checked, "demographics", on_violation)
    batch, result = narrow(found.good, "demographics"), found.result
    stored = read_table(spark, warehouse, "demographics")
    keys = UNIQUE_KEYS["demographics"]
    if on_conflict == "update":
        now = F.localtimestamp()
        stamps = {"created_at": now, "updated_at": now}
        merge_rows(batch, warehouse, "demographics", DEMOGRAPHIC_FIGURES, stamps, keep_missing=True, touch={"updated_at": now})
    else:
        # The merge holds each key once, so any constant serves as the row order of "skip".
        added = insert_unique(stored, batch, keys, on_conflict, F.lit(0))
        if on_conflict == "skip":
            added = staged(added, "demographics-new")
            result.rows_written = added.count()
        append(with_defaults(added, "demographics"), warehouse, "demographics", load_id)
    for part in [*parts, found]:
        part.quarantine(warehouse, load_id)
    seen = parts[0].result + parts[1].result
    return result + LoadResult(0, seen.rows_rejected, seen.reasons)


@in_staging
def load_dpe(
    spark: SparkSession,
    root: str,
    warehouse: str,
    departments: list[str] | None = None,
    on_violation: str = "quarantine",
    load_id: str = "",
    quoted_breaks: bool = False,
) -> LoadResult:
    """Append all diagnoses, or those of communes that the register places in the given departments.

    Landing folders named by department are pruned by the choice as well.
    """
    communes = known_communes(spark, warehouse)
    raw = landing.read_dpe(spark, root, departments, quoted_breaks=quoted_breaks)
    if departments:
        raw = of_departments(raw, communes, departments)
    found = settle(judged(screen_dpe(raw).drop("_pos"), "dpe", communes), "dpe", on_violation)
    append(with_defaults(narrow(found.good, "dpe"), "dpe"), warehouse, "dpe", load_id)
    found.quarantine(warehouse, load_id)
    return found.result


def of_departments(raw: DataFrame, communes: DataFrame, departments: list[str]) -> DataFrame:
    """Landed diagnoses whose commune the register places in one of the departments.

    Rows with a code the register does not know stay: they are judged, and set aside with a reason.
    """
    elsewhere = communes.where(~F.col("dept").isin(departments)).select("code_insee")
    return raw.join(elsewhere, text_field(F.col("`Code_INSEE_(BAN)`")) == F.col("code_insee"), "left_anti")


def tracked(
    spark: SparkSession,
    warehouse: str,
    name: str,
    table: str,
    load: Callable[[str], LoadResult],
    metadata: dict | None = None,
    pipeline_id: str | None = None,
) -> bool:
    """Run one load under the ledger; it gets the run's id. A failure is recorded, and does not stop the next load."""
    path = f"{warehouse}/{EVENTS_FOLDER}"
    run_id = start_run(spark, path, name, metadata, pipeline_id)
    try:
        result = load(run_id)
        total = read_table(spark, warehouse, table).count()
    except Exception as error:  # the ledger keeps whatever went wrong
        log_event(spark, path, run_id, name, FAILED, error=str(error), metadata=metadata, pipeline_id=pipeline_id)
        return False
    log_event(
        spark, path, run_id, name, SUCCESS, result.rows_written, total, metadata=metadata, pipeline_id=pipeline_id
    )
    return True


def load_all(
    spark: SparkSession,
    root: str,
    warehouse: str,
    year: int = 2023,
    departments: list[str] | None = None,
    skip_communes: bool = False,
    together: bool = False,
    quoted_breaks: bool = False,
    **options,
) -> dict[str, bool]:
    """All four loads in foreign-key order, as one pipeline of the ledger; says which of them succeeded.

    One scan takes all chosen departments together. With ``together`` the tables show what was loaded at once, when all
    loads are done, and none of it if another writer was first or a load failed (which is then an error).
    """
    if together:
        with staging(spark), transaction(spark, warehouse):
            done = load_all(spark, root, warehouse, year, departments, skip_communes, quoted_breaks=quoted_breaks, **options)
            if not all(done.values()):
                raise LoadFailed(f"nothing was committed: {done}")
        return done
    scope = {"departments": departments} if departments else {"scope": "france"}
    pipeline_id = uuid.uuid4().hex

    def run(table: str, load: Callable[[str], LoadResult], metadata: dict | None = None) -> bool:
        return tracked(spark, warehouse, f"{table}_loader", table, load, metadata, pipeline_id)

    done: dict[str, bool] = {}
    if not skip_communes:
        done["communes"] = run("communes", lambda run_id: load_communes(spark, root, warehouse, load_id=run_id, quoted_breaks=quoted_breaks))
    done["transactions"] = run(
        "transactions",
        lambda run_id: load_transactions(
            spark, root, warehouse, [year], departments, load_id=run_id, quoted_breaks=quoted_breaks, **options
        ),
        {"year": year, **scope},
    )
    done["demographics"] = run(
        "demographics",
        lambda run_id: load_demographics(spark, root, warehouse, year, load_id=run_id, quoted_breaks=quoted_breaks),
        {"year": year},
    )
    done["dpe"] = run(
        "dpe",
        lambda run_id: load_dpe(spark, root, warehouse, departments, load_id=run_id, quoted_breaks=quoted_breaks),
        scope,
    )
    return done


@in_staging
def remove_communes(spark: SparkSession, warehouse: str, deleted: DataFrame, load_id: str = "") -> None:
    """Delete communes (``code_insee`` rows) and, with them, their rows in every child table.

    Marks are written, and no row anew; ``compact`` writes the folders concerned without the rows when it suits.
    """
    gone = staged(deleted.select("code_insee").distinct(), "deleted")
    for child in CHILD_TABLES:
        # A row that another load adds meanwhile may belong to a commune that goes.
        current(spark, warehouse).rely_on(child)
        remove_rows(spark, warehouse, child, gone.withColumnRenamed("code_insee", "commune_id"), "commune_id")
    remove_rows(spark, warehouse, "communes", gone, "code_insee")
