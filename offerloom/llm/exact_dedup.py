"""Exact dedup by progressive refinement: length, then a hash of the prefix, then a digest of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.llm.common import fresh, materialize

#: Slots of the broadcast filter; a proven bound of its size (so many integers at most), whatever the input.
SLOTS = 1 << 20


def _candidates(docs: DataFrame, text: Column, prefix_chars: int, used: str) -> DataFrame:
    """``docs`` with ``used``: true for rows whose text may have an equal, null for rows whose length or prefix is unique.

    One pre-aggregated count by (length, prefix hash) decides both: a class that occurs once, and so a length that occurs once, is
    settled. The other classes are hashed to ``SLOTS`` slots; the list of used slots is broadcast, so no text moves.
    """
    n, head, slot = fresh(docs, "len_", "head_", "slot_")
    hashed = docs.withColumns({n: F.length(text), head: F.xxhash64(F.substring(text, 1, prefix_chars))})
    repeated = hashed.groupBy(n, head).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    slot_of = F.pmod(F.xxhash64(n, head), F.lit(SLOTS)).cast("int")
    slots = repeated.select(slot_of.alias(slot)).distinct().withColumn(used, F.lit(True))
    return hashed.withColumn(slot, slot_of).join(F.broadcast(slots), slot, "left").drop(n, head, slot)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 128) -> DataFrame:
    """Group rows whose texts are identical and keep, of each group, the row with the largest id.

    Returns every row once, with all its columns and keep_id (id of the row that stays), group_size and kept.

    Rows are counted by text length and by hash of the first ``prefix_chars`` characters. Only rows of a class that occurs twice (and
    of its slot of the filter) have their whole text digested (SHA-256), where they were read; equal digests form a group. Counts
    are pre-aggregated in the map tasks, and what is joined back is one row per group, by broadcast for groups with more than a
    thousandth of all copies, so no key of the shuffle is frequent. No step shuffles text that the caller doesn't select. Once all
    slots are used (some million repeated classes), every row is digested, which costs hashing and no shuffle; the result is the same.

    A null text counts as empty; all empty texts form one group. An id of null is kept as null and never chosen over another id.
    Rows that repeat both id and text are all marked kept. An empty table gives an empty result. Extra columns pass through;
    columns named keep_id, group_size or kept are replaced.
    """
    docs = docs.drop("keep_id", "group_size", "kept")
    used, key = fresh(docs, "used_", "key_")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Rows that no other equals meet no group; keys of their own spread them over the tasks.
    alone = F.coalesce(F.col(id_col).cast("string"), F.xxhash64(text).cast("string"))
    digest = F.when(F.col(used), F.concat(F.lit("t"), F.sha2(text, 256))).otherwise(F.concat(F.lit("i"), alone))
    rows = _candidates(docs, text, prefix_chars, used).withColumn(key, digest)
    groups = rows.where(F.col(used)).groupBy(key).agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    groups = materialize(groups, "groups")
    # Groups with more than a thousandth of all copies, fewer than a thousand, are broadcast; their rows then spread like single ones.
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    large = F.col("group_size") * 1000 > total
    keep, size = fresh(rows, "keep_", "size_")
    hot = groups.where(large).withColumnsRenamed({"keep_id": keep, "group_size": size})
    rows = rows.drop(used).join(F.broadcast(hot), key, "left").withColumn(key, F.when(F.col(size).isNull(), F.col(key)).otherwise(F.concat(F.lit("i"), alone)))
    out = rows.join(groups.where(~large), key, "left").drop(key)
    out = out.withColumns({"keep_id": F.coalesce("keep_id", keep), "group_size": F.coalesce("group_size", size)}).drop(keep, size)
    alone = F.col("group_size").isNull()
    return out.withColumns({
        "keep_id": F.when(alone, F.col(id_col)).otherwise(F.col("keep_id")),
        "group_size": F.coalesce(F.col("group_size"), F.lit(1)).cast("long"),
        "kept": alone | F.col(id_col).eqNullSafe(F.col("keep_id")),
    })


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 128) -> DataFrame:
    """One row of each text stays, the one with the largest id, with all its columns.

    The refinement is that of :func:`exact_dedup`. Rows that it settles early stay where they are; the others are digested and meet
    by digest, and each map task passes on one row of each digest only, so a group that holds a third of all rows doesn't meet whole.

    A null text counts as empty. An id of null loses to any other. Of rows that agree in id and text one stays, chosen by a hash of
    all columns. Rows that share an id but no text all stay. An empty table gives an empty result.
    """
    used, key, rank = fresh(docs, "used_", "key_", "rank_")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _candidates(docs, text, prefix_chars, used)
    order = Window.partitionBy(key).orderBy(F.col(id_col).desc_nulls_last(), F.xxhash64(*[F.col(c) for c in docs.columns]))
    first = rows.where(F.col(used)).withColumn(key, F.sha2(text, 256)).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return rows.where(F.col(used).isNull()).select(*docs.columns).unionByName(first.select(*docs.columns))
