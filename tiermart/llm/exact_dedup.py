"""Exact deduplication by sorting contents.

Rows are dealt to slots by splitters that were sampled from their sort keys, every
slot is sorted, and neighbours are compared in full. The sort key is the first 64
bytes of a text, the digest of the whole text and the row's id, so a key has a
fixed size however long the text is, equal texts stand side by side, and a text
that a third of all rows share is spread over as many slots as its rows need.
Only the first and the last run of a slot can go on in another slot; they are
joined by their digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import fresh, stored

PREFIX = 64
OVERSAMPLE = 16


def _ordered_bytes(number: Column) -> Column:
    """Eight bytes that sort like a signed long; null sorts first, as no bytes."""
    flipped = number.cast("long").bitwiseXOR(F.lit(-(2**63)).cast("long"))
    return F.coalesce(F.unhex(F.lpad(F.hex(flipped), 16, "0")), F.lit(b""))


def _slot(key: Column, splitters: list[bytes]) -> Column:
    """How many splitters are not above ``key``, by halving."""
    if not splitters:
        return F.lit(0)
    edges = F.array(*[F.lit(s) for s in splitters])

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state.low + state.high) / 2).cast("int")
        open_ = state.low < state.high
        below = F.get(edges, middle) <= key
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state.low).alias("low"),
            F.when(open_ & ~below, middle).otherwise(state.high).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(splitters)).alias("high"))
    steps = F.array(*[F.lit(i) for i in range(len(splitters).bit_length())])
    return F.aggregate(steps, start, halve, lambda s: s.low)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int | None = None, normalise=lambda text: text) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when ``normalise`` makes them identical; null counts as empty.
    Of equal texts the row with the largest id stays, and of rows that repeat that
    id too, exactly one. A null id is smaller than any other. Other columns of
    ``docs`` do not matter, whatever their names. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    slots = slots or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(normalise(F.col(text_col)), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body")).withColumn("sha", F.sha2("body", 256))
    key = F.concat(F.rpad(F.substring("body", 1, PREFIX), PREFIX, F.lit(b"\0")), F.unhex("sha"), _ordered_bytes(F.col("id")))
    rows = rows.withColumn("key", key)

    # A sample of bounded size: OVERSAMPLE keys of about 100 bytes for each slot.
    n = docs.count()
    share = min(1.0, slots * OVERSAMPLE / max(n, 1))
    sampled = sorted(bytes(r[0]) for r in rows.select("key").sample(share, seed=17).toLocalIterator()) if slots > 1 and n else []
    splitters = sorted({sampled[i * len(sampled) // slots] for i in range(1, slots)}) if sampled else []

    in_slot = Window.partitionBy("slot").orderBy("key")
    heads = (
        rows.withColumn("slot", _slot(F.col("key"), splitters))
        .withColumn("head", F.coalesce(F.lag("body").over(in_slot) != F.col("body"), F.lit(True)))
        .select("id", "sha", "slot", "key", "head")
    )
    run = Window.partitionBy("slot", "run")
    runs = (
        heads.withColumn("run", F.sum(F.col("head").cast("long")).over(in_slot.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("place", F.row_number().over(in_slot))
        .withColumn("last_run", F.max("run").over(Window.partitionBy("slot")))
        .withColumn("size", F.count(F.lit(1)).over(run))
        .withColumn("end", F.max("place").over(run))
        .withColumn("most", F.max("id").over(run))
        .drop("key", "head")
    )
    # Narrow rows; stored, so that the texts move once although the runs are read twice.
    runs = stored(runs, "runs")

    # At most two runs of a slot touch another slot.
    border = (F.col("run") == 1) | (F.col("run") == F.col("last_run"))
    edge = runs.filter(border & (F.col("place") == F.col("end"))).select("slot", "run", "sha", "size", "most")
    whole = edge.groupBy("sha").agg(
        F.sum("size").alias("all_size"), F.max("most").alias("all_most"), F.max("slot").alias("last_slot")
    )
    edge = edge.join(whole, "sha").select("slot", "run", "all_size", "all_most", "last_slot")
    joined = runs.join(edge, ["slot", "run"], "left")
    is_last = (F.col("place") == F.col("end")) & (F.col("slot") == F.coalesce("last_slot", "slot"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("all_most", "most").alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        is_last.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text; ids may repeat.

    Rows that repeat an id and a text are reduced to one in each task before they move, and
    stay where the join needs them.
    """

    name = fresh(docs.columns, "key")

    def key(sha: Column) -> Column:
        return F.concat(sha, F.when(F.col(id_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(id_col).cast("string")))).alias(name)

    kept = exact_groups(docs, id_col, text_col).filter("kept").select(key(F.col("text_sha256")))
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    single = docs.select("*", key(sha)).dropDuplicates([name])
    return single.join(kept, name, "left_semi").select(*docs.columns)
