"""Shards of bounded size by extendible hashing.

A row's place comes from the leading bits of a hash of its id. A directory over those
bits starts with one shard; only a shard above the byte limit splits on one more bit, so
shards have as many bits as their own rows need. Sizes are summed once for cells of a
fixed number of bits, and all levels of the directory above them follow from the cells.
Cells that are still too large, if any, are cut in the same way by further bits: of the
hash of the id, then of id and text, then of the row's number, so that rows that repeat
one id are split too. A shard of one row cannot be split and may lie above the limit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import stored

LIMIT = 16 << 20
BITS = 60  # of each hash
SPARE = 6  # bits of the cells beyond those that equal shards would need
MORE = 12  # further bits for cells that are too large


def _bits(text: Column) -> Column:
    """The first 60 bits of a digest as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _level(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Directory of cells of ``high`` bits: (path, cell, shard, depth, shard_bytes, shard_rows).

    Rows have a ``path``, the bits that led to their part of the directory, ``cell`` and
    ``bytes``; ``low`` bits of the cell are in the path already. ``shard`` is null where even the
    whole cell does not fit.
    """
    cells = stored(rows.groupBy("path", "cell").agg(F.sum("bytes").alias("bytes"), F.count("bytes").alias("rows")), "cells")
    above = cells.select("path", "cell", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    above = above.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    totals = above.groupBy("path", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    fits = (F.col("bytes") <= limit) | (F.col("rows") == 1)
    # A larger prefix holds more, so the shard of a cell is its shortest prefix that fits.
    whole = above.select("path", "cell", "depth", "prefix").join(totals.filter(fits), ["path", "depth", "prefix"])
    best = whole.groupBy("path", "cell").agg(F.min(F.struct("depth", "prefix", "bytes", "rows")).alias("s"))
    digits = F.lpad(F.bin("s.prefix"), F.col("s.depth"), F.lit("0"))
    mine = F.when(F.col("s.depth") == 0, "").otherwise(digits)
    found = best.select("path", "cell", mine.alias("shard"), F.col("s.depth").alias("depth"), F.col("s.bytes").alias("shard_bytes"), F.col("s.rows").alias("shard_rows"))
    return stored(cells.select("path", "cell").join(found, ["path", "cell"], "left"), "directory")


def shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``shard``, ``depth``, ``shard_bytes``, ``shard_rows``.

    ``shard`` is the string of hash bits that names the shard, empty if one shard holds all;
    further hashes follow after a slash. A row weighs its text's UTF-8 bytes, null nothing.
    Null ids hash as an empty string.
    """
    name, text = F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = [_bits(name), _bits(F.concat(name, F.lit("\n"), text)), _bits(F.monotonically_increasing_id().cast("string"))]
    narrow = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("bytes"), *[k.alias(f"h{i}") for i, k in enumerate(keys)], F.lit("").alias("path")
    )
    rows = stored(narrow, "rows")
    total, count = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("bytes")).first()
    out: DataFrame | None = None
    key, low = 0, 0
    high = min(BITS, SPARE + math.ceil(math.log2(max(1, total / limit))))
    while count:
        rows = rows.withColumn("cell", F.shiftright(f"h{key}", BITS - high))
        directory = _level(rows, low, high, limit)
        placed = rows.join(directory, ["path", "cell"])
        label = F.concat("path", "shard")
        here = placed.filter("shard IS NOT NULL").select("id", label.alias("shard"), (F.col("depth") + key * BITS).alias("depth"), "shard_bytes", "shard_rows")
        out = here if out is None else out.unionByName(here)
        if directory.filter("shard IS NULL").isEmpty():
            break
        left = placed.filter("shard IS NULL")
        if high < BITS:
            low, high = high + 1, min(BITS, high + MORE)
        elif key < len(keys) - 1:
            # All bits of this hash are used up: they join the path.
            left = left.withColumn("path", F.concat("path", F.lpad(F.bin("cell"), BITS, "0"), F.lit("/")))
            key, low, high = key + 1, 0, MORE
        else:
            raise ValueError("rows that differ in their numbers have equal hashes")
        rows = stored(left.select("id", "bytes", "h0", "h1", "h2", "path"), "rows")
    if out is None:
        out = rows.select("id", F.col("path").alias("shard"), F.lit(0).alias("depth"), F.col("bytes").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_rows"))
    return out.withColumnRenamed("id", id_col)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """``docs`` as one folder of Parquet files for each shard; ids must be unique."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = docs.join(placed.select(F.col(id_col), F.concat(F.lit("s"), F.translate("shard", "/", "-")).alias("shard")), id_col)
    both.repartition(parts, "shard").write.partitionBy("shard").parquet(path)
