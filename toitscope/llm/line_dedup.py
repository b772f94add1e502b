"""Repeated passages of lines, removed where the same bytes stand earlier in the corpus.

There are two ways to look for them. Chunks: a rolling hash over the hashes of a text's lines says where a chunk ends,
so the same passage is cut alike wherever it stands, but its lines before the first and after the last common boundary
stay. Whole passages: from each line that has words the shortest window of lines, forwards and backwards, that is long
enough to count. A passage that is long enough holds such a window from its first line and one up to each line after
the end of that, so these windows cover all of it, whatever stands around it. Chunks or windows whose hash occurs more
than once in the corpus are compared by their bytes; the first occurrence stays.

Texts are cut twice rather than stored: the first pass sends one hash per chunk; a bitmap, built from the repeated
hashes alone, then tells the second pass which chunks to send whole. A bit set by another hash costs a chunk sent for
nothing, never a result. What is removed goes back to its text as spans, one join of the corpus with the rows that
lose lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm.shared import small_batches, staged, text_of

WINDOW = 2
DIVISOR = 2
LEAST_LINES = 2
LEAST_WORDS = 10
#: A line of so many words is a passage by itself.
LEAST_LINE_WORDS = 51
BITMAP_BITS = 25
#: The bitmap grows with the repeated hashes up to 2^29 bits, 64 MB.
MOST_BITMAP_BITS = 29

_MASK = (1 << 64) - 1
_TIMES = 0x9E3779B97F4A7C15


def line_chunks(text: bytes, window: int, divisor: int, least_lines: int, least_words: int) -> list[tuple[int, int, int]]:
    """Hash, start and end of each chunk that may be removed; a chunk ends before the line break after its last line.

    A boundary follows a line when the rolling hash over the last ``window`` lines says so and the chunk has
    ``least_lines``; the last chunk ends with the text. Chunks of fewer lines or words are left out.
    """
    lines = text.split(b"\n")
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    out_of = pow(_TIMES, window, 1 << 64)
    rolling, start, at, first = 0, 0, 0, 0
    out = []
    for i, line in enumerate(lines):
        rolling = (rolling * _TIMES + hashes[i]) & _MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * out_of) & _MASK
        end = at + len(line)
        at = end + 1
        count = i + 1 - first
        last = i + 1 == len(lines)
        if last or (count >= least_lines and i + 1 >= window and ((rolling ^ rolling >> 32) * _TIMES & _MASK) >> 40 & 0xFFFF < 65536 // divisor):
            chunk = text[start:end]
            if count >= least_lines and len(chunk.split()) >= least_words:
                out.append((xxhash.xxh64_intdigest(chunk, seed=1) - (1 << 63), start, end))
            start, first = at, i + 1
    return out


def passage_windows(text: bytes, least_lines: int, least_words: int, least_line_words: int) -> list[tuple[int, int, int]]:
    """Hash, start and end of the windows of lines that cover every passage which may be removed.

    A passage begins and ends with a line that has words and has ``least_lines`` such lines and ``least_words``, or is
    a line of ``least_line_words``, or one of ``least_words`` and a blank line beside it where two lines are enough. A
    blank line belongs to the windows of fewer than ``least_words`` lines around it, so long runs of them add little.
    """
    lines = text.split(b"\n")
    words = [len(line.split()) for line in lines]
    starts = [0, *accumulate(len(line) + 1 for line in lines)]
    full = [i for i, n in enumerate(words) if n]
    found = set()
    for backwards in (True, False):
        first = total = 0
        order = full if backwards else full[::-1]
        for at, line in enumerate(order):
            total += words[line]
            while at - first >= least_lines and total - words[order[first]] >= least_words:
                total -= words[order[first]]
                first += 1
            if total >= least_words and at - first + 1 >= least_lines:
                found.add((order[first], line) if backwards else (line, order[first]))
    for i in full:
        if words[i] >= least_line_words:
            found.add((i, i))
        elif words[i] >= least_words and least_lines <= 2:
            if i and not words[i - 1]:
                found.add((i - 1, i))
            if i + 1 < len(lines) and not words[i + 1]:
                found.add((i, i + 1))
    spans = [(starts[i], starts[j + 1] - 1) for i, j in found]
    return [(xxhash.xxh64_intdigest(text[a:b], seed=1) - (1 << 63), a, b) for a, b in spans]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without some of its chunks and the line break after each; chunks may overlap."""
    data = text.encode("utf-8", "surrogatepass")
    kept, at = [], 0
    for start, end in sorted(spans):
        kept.append(data[at:start])
        at = max(at, min(len(data), end + 1))
    kept.append(data[at:])
    out = b"".join(kept)
    if any(end >= len(data) for _, end in spans) and out.endswith(b"\n"):
        out = out[:-1]
    return out.decode("utf-8", "surrogatepass")


def _bitmap(repeated: DataFrame, bits: int) -> np.ndarray:
    """One bit for the low bits of each repeated hash: 2^bits bits, however many hashes there are."""
    slot = F.shiftrightunsigned("hash", 64 - bits)
    pieces = (
        repeated.select(F.shiftright(slot, 15).alias("piece"), (slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("bit"))
        .groupBy("piece")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces:
        at = row["piece"] << 12
        out[at : at + (1 << 12)] = np.frombuffer(row["bits"], np.uint8)
    return out


def removals(
    docs: DataFrame,
    window: int = WINDOW,
    divisor: int = DIVISOR,
    least_lines: int = LEAST_LINES,
    least_words: int = LEAST_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    whole: bool = False,
    least_line_words: int = LEAST_LINE_WORDS,
) -> DataFrame:
    """Rows that lose lines: ``doc_id, text_hash, spans`` (byte positions ``start, end`` of the chunks to remove).

    With ``whole`` all of each repeated passage goes, otherwise the repeated chunks in it. Spans of one row may
    overlap. Bytes that overlap their own first occurrence are no copy of it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    cut = passage_windows if whole else line_chunks
    how = (least_lines, least_words, least_line_words) if whole else (window, divisor, least_lines, least_words)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [c[0] for t in batch.column(0).to_pylist() for c in cut(t.encode("utf-8", "surrogatepass"), *how)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["hash"])

    repeated = staged(
        read.select("text").mapInArrow(hashes, "hash bigint").groupBy("hash").count().where("count > 1").select("hash"),
        "chunk-hashes",
    )
    size = min(MOST_BITMAP_BITS, max(BITMAP_BITS, (16 * repeated.count()).bit_length()))
    bits = spark.sparkContext.broadcast(_bitmap(repeated, size))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = bits.value
        for batch in batches:
            row, found, texts = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for chunk in cut(data, *how):
                    slot = (chunk[0] & _MASK) >> (64 - size)
                    if bitmap[slot >> 3] >> (slot & 7) & 1:
                        row.append(i)
                        found.append(chunk)
                        texts.append(data[chunk[1] : chunk[2]])
            at = pa.array(row, pa.int64())
            numbers = [pa.array([c[k] for c in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *numbers, pa.array(texts, pa.binary())], names=names
            )

    names = ["doc_id", "text_hash", "hash", "start", "end", "chunk"]
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType)]
        + [T.StructField(n, T.LongType()) for n in names[1:-1]]
        + [T.StructField("chunk", T.BinaryType())]
    )
    sent = staged(read.select("doc_id", "text_hash", "text").mapInArrow(chunks, schema), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "start")
    # Grouping by the bytes themselves is the comparison; a task sends each of its different chunks once.
    firsts = staged(
        sent.groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "chunk-firsts",
    )
    same_text = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    overlaps = F.col("start") <= F.col("first.start") + F.col("end") - F.col("start")
    later = sent.join(firsts, ["hash", "chunk"]).where(~(same_text & overlaps))
    return staged(
        later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "chunk-removals"
    )


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series(
        [
            text if found is None or not len(found) else without(text or "", [(s["start"], s["end"]) for s in found])
            for text, found in zip(texts, spans, strict=True)
        ],
        dtype=object,
    )


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """``docs`` with every repeated chunk of lines removed but for its first occurrence; all rows and columns stay.

    With ``whole`` every repeated passage goes from its first line to its last, also one that holds no chunk. A line
    that goes stands still at an earlier place: where passages overlap, the shared lines may stand in another one.
    First is the least id, a null one last, then the least position. Rows that agree in id and text are one place:
    all of them keep a chunk or none. Null and empty texts stay as they are. ``n_chars``, where there is one, is
    counted anew for texts that changed. An empty table gives an empty one.
    """
    gone = removals(docs, id_column=id_column, text_column=text_column, **how).select(
        F.col("doc_id").alias("_lines_id"), F.col("text_hash").alias("_lines_hash"), F.col("spans").alias("_lines_spans")
    )
    at_row = (F.xxhash64(text_of(text_column)) == F.col("_lines_hash")) & F.col(id_column).eqNullSafe(F.col("_lines_id"))
    # Merged at every size: texts move once, in proportion to the corpus, and a hot row is split.
    joined = docs.join(gone.hint("merge"), at_row, "left").withColumn(text_column, _without(F.col(text_column), F.col("_lines_spans")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("_lines_spans").isNull(), F.col("n_chars")).otherwise(F.length(text_column).cast(kind))
        joined = joined.withColumn("n_chars", counted)
    return joined.select(*docs.columns)
