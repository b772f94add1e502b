"""Delimited files whose quoted fields hold line breaks, read in splits.

Spark splits such a file only if every line is a row. Here lines are read as text, split as usual, and then joined to
records. What a line does to the quotes is a function of whether it begins inside a quoted field: most lines leave that
as it is or end it whatever it was. The lines are stored once, with what they do, and later steps read the columns they
need. Functions of neighbouring lines compose, so every run of some ten thousand lines of a file is summed up to one, a
running composition over the runs of a file says how each begins, and with that how each line does. What a line is either
way, begun outside or inside, is found in one pass over its run and stored, so lines are put in order once. Lines that
begin and end outside quotes are records as they are and never meet other lines; only files in which some line ends
inside a quoted field are put in order at all.

A record of more lines than ``MOST_LINES`` is taken for a quote that nobody closed: its lines are kept one by one and
marked ``open_quote``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toitscope.operators.storage import staged

MOST_LINES = 1000
KEEP, FLIP, OUTSIDE, INSIDE = 0, 1, 2, 3
#: A run has as many lines at most, as a power of 2; part of its key is the number of its file, that of the file's first line.
RUN_BITS = 16
RUN = ["_number", "_block", "_run"]

#: The rest of a quoted field up to its closing quote; a doubled quote does not close it.
_CLOSING = '[^"]*+(?:""[^"]*+)*+"'


def _ends_inside(text: Column, separator: str) -> Column:
    """Whether a line that begins outside quotes ends inside: a field opens and nothing closes it."""
    opening = f"(^|{re.escape(separator)})\""
    return F.regexp_replace(text, opening + _CLOSING, "$1").rlike(opening)


def effect(line: Column, separator: str) -> Column:
    """What a line does to the quotes: keep, flip, or end outside or inside whatever was before."""
    from_outside = _ends_inside(line, separator)
    closes = line.rlike("^" + _CLOSING)
    # What follows a closing quote is no start of a field until the next separator.
    from_inside = ~closes | _ends_inside(F.regexp_replace(line, "^" + _CLOSING, "x"), separator)
    return (
        F.when(~line.contains('"'), KEEP)
        .when(from_outside & from_inside, INSIDE)
        .when(from_outside, FLIP)
        .when(from_inside, KEEP)
        .otherwise(OUTSIDE)
    )


def _composed(kind: Column, over) -> tuple[Column, Column]:
    """Of all effects so far: the parity of flips, and the last fixed end less that parity at its time (null: none)."""
    flips = F.sum((kind == FLIP).cast("int")).over(over) % 2
    fixed = F.when(kind >= OUTSIDE, (kind - OUTSIDE).bitwiseXOR(flips))
    return flips, F.last(fixed, ignorenulls=True).over(over)


def located_lines(scanned: DataFrame) -> DataFrame:
    """``line``, the folder columns, and the file and the block of the file each line of a text scan comes from."""
    return scanned.withColumnRenamed("value", "line").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def records(lines: DataFrame, separator: str, most_lines: int = MOST_LINES) -> DataFrame:
    """Lines of ``located_lines`` joined to records, without those that are blank outside quotes.

    ``line`` is the record, its line breaks are ``\\n``; it has the place of its first line. ``_row`` numbers the
    records of a block in order, ``_head`` marks the first one of a file, ``_open`` lines behind an open quote.
    """
    # Lines of a block are numbered in order by the task that reads it.
    lines = lines.withColumn("_row", F.monotonically_increasing_id())
    marked = staged(lines.withColumn("_effect", effect(F.col("line"), separator)), "lines", lasting=True)
    # One row for each file: its number, its first line, and whether some line of it leaves a field open.
    files = marked.groupBy(F.col("_file").alias("_f_file")).agg(
        F.min("_row").alias("_number"),
        F.min(F.when(F.col("_block") == 0, F.col("_row"))).alias("_first"),
        F.bool_or(F.col("_effect").isin(FLIP, INSIDE)).alias("_mixed"),
    )
    # Staged, so that Spark knows how small it is before it deals out the lines.
    files = staged(files, "files", lasting=True)
    marked = marked.join(files, F.col("_file") == F.col("_f_file"))
    head = (F.col("_block") == 0) & (F.col("_row") == F.col("_first"))
    kept = [*lines.columns, "_head"]
    others = [c for c in lines.columns if c not in ("line", "_file", "_block", "_row")]
    whole = marked.where(~F.col("_mixed")).withColumn("_head", head).select(*kept, F.lit(False).alias("_open"))

    run = staged(_in_runs(marked.where("_mixed").select("line", *others, "_number", "_block", "_row", "_effect")), "runs", lasting=True)
    begins = staged(_begins(run).join(files.drop("_mixed"), "_number"), "begins", lasting=True)
    named = run.join(begins, RUN).withColumn("_head", head)
    inside = F.col("_begins") == 1
    named = named.withColumns(
        {
            "_before": F.when(inside, F.col("_before_1")).otherwise(F.col("_before_0")),
            # A record is named by its first line; one that goes on into a run is named by an earlier run's last start.
            "_start": F.coalesce(F.when(inside, F.col("_start_1")).otherwise(F.col("_start_0")), F.col("_carried")),
        }
    )
    named = named.withColumn("_after", _applied(F.col("_effect"), F.col("_before"))).withColumnRenamed("_f_file", "_file")
    alone = named.where("_before = 0 AND _after = 0").select(*kept, F.lit(False).alias("_open"))
    parts = named.where("_before = 1 OR _after = 1")
    # The size of a record is known before its lines meet, so one that nobody closes never does.
    endless = parts.groupBy("_start").agg(F.count("*").alias("_lines")).where(F.col("_lines") > most_lines).select("_start")
    endless = staged(endless, "endless", lasting=True)
    lost = parts.join(endless, "_start", "left_semi").select(*kept, F.lit(True).alias("_open"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_row", "line", "_after")))
    joined = (
        parts.join(endless, "_start", "left_anti")
        .groupBy("_start")
        .agg(pieces.alias("_pieces"), F.bool_or("_head").alias("_head"), *[F.first(c).alias(c) for c in ["_file", *others]])
    )
    text = F.array_join(F.transform("_pieces", lambda p: p["line"]), "\n")
    still_open = F.element_at("_pieces", -1)["_after"] == 1
    begun = F.element_at("_pieces", 1)
    joined = joined.select(
        *[{"line": text, "_block": begun["_block"], "_row": F.col("_start")}.get(c, F.col(c)).alias(c) for c in kept],
        still_open.alias("_open"),
    )
    return whole.unionByName(alone).unionByName(lost).unionByName(joined).where(F.trim("line") != "")


def _applied(kind: Column, before: Column) -> Column:
    """Whether a quoted field is open (1) after a line with this effect."""
    return F.when(kind == KEEP, before).when(kind == FLIP, 1 - before).otherwise(kind - OUTSIDE)


def _in_runs(lines: DataFrame) -> DataFrame:
    """What each line of a mixed file is if its run begins outside (0) or inside (1): ``_before`` and ``_start``, its record's first line.

    A run is some lines in a row of one block, so that a window over it is small whatever the size of the block.
    """
    lines = lines.withColumn("_run", F.shiftright("_row", RUN_BITS))
    so_far = Window.partitionBy(*RUN).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("_effect")
    flipped = (kind == FLIP).cast("int")
    found = lines.withColumn("_flips", F.sum(flipped).over(so_far) % 2)
    fixed = F.when(kind >= OUTSIDE, (kind - OUTSIDE).bitwiseXOR(F.col("_flips").cast("int")))
    found = found.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(earlier))
    # The parity before a line is that after it without the line's own.
    parity = F.col("_flips").cast("int").bitwiseXOR(flipped)
    found = found.withColumns({f"_before_{b}": F.coalesce("_fixed", F.lit(b)).bitwiseXOR(parity) for b in (0, 1)})
    starts = {f"_start_{b}": F.last(F.when(F.col(f"_before_{b}") == 0, F.col("_row")), ignorenulls=True).over(so_far) for b in (0, 1)}
    return found.withColumns(starts).drop("_flips", "_fixed")


def _begins(run: DataFrame) -> DataFrame:
    """For each run how it begins, and the last start before it in its file."""
    ends = [_applied(F.col("_effect"), F.col(f"_before_{b}")).alias(f"_end_{b}") for b in (0, 1)]
    runs = run.groupBy(*RUN).agg(
        F.max_by(F.struct(*ends), "_row").alias("_end"), F.max("_start_0").alias("_last_0"), F.max("_start_1").alias("_last_1")
    )
    same = F.col("_end._end_0") == F.col("_end._end_1")
    does = F.when(same, OUTSIDE + F.col("_end._end_0")).otherwise(F.col("_end._end_0"))
    runs = runs.select(*RUN, "_last_0", "_last_1", does.alias("_effect"))
    in_file = Window.partitionBy("_number").orderBy("_block", "_run")
    flips, fixed = _composed(F.col("_effect"), in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.withColumn("_ended", F.coalesce(fixed, F.lit(0)).bitwiseXOR(flips))
    runs = runs.withColumn("_begins", F.lag("_ended", 1, 0).over(in_file))
    last = F.when(F.col("_begins") == 1, F.col("_last_1")).otherwise(F.col("_last_0"))
    carried = F.last(last, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return runs.select(*RUN, "_begins", carried.alias("_carried"))


def parsed(rows: DataFrame, names: list[str], separator: str, corrupt: str) -> DataFrame:
    """Records as text columns of the given names and ``corrupt``, as a delimited reader gives them, without headers.

    A file whose header differs is an error.
    """
    layout = ", ".join(f"`{n}` string" for n in [*names, corrupt])
    options = {"sep": separator, "escape": '"', "columnNameOfCorruptRecord": corrupt}
    split = rows.withColumn("_values", F.from_csv("line", layout, options))
    given = F.array(*[F.coalesce(F.col("_values").getField(n), F.lit("")) for n in names])
    # The mark of UTF-8 at the start of a file is no part of its header.
    given = F.transform(given, lambda name: F.trim(F.regexp_replace(name, "^\\uFEFF", "")))
    differs = F.col("_head") & (given != F.array(*[F.lit(n.strip()) for n in names]))
    message = F.concat(F.lit("the header differs in "), F.col("_file"))
    body = split.where(F.when(differs, F.raise_error(message).cast("boolean")).otherwise(~F.col("_head")))
    rest = [c for c in rows.columns if c not in ("line", "_head")]
    return body.select("_values.*", *rest)
