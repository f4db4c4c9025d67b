"""Mixing sources to target weights by Pfair scheduling: blocks with release times and deadlines, earliest deadline first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import distributed_rank, fresh, materialize

#: Sources and, unless the caller sets the size of a block, blocks at most (but for the last ones of the sources): they bound the schedule.
MOST_SOURCES, MOST_BLOCKS = 100_000, 1 << 17


def capped_weights(counts: dict[str, int], cap: float) -> dict[str, float]:
    """Shares of the sources, none above ``cap`` (or 1 / number of sources, if that is more); the others keep their proportions."""
    total, capped = sum(counts.values()), set()
    cap = max(cap, 1 / len(counts))
    while True:
        rest = sum(n for s, n in counts.items() if s not in capped)
        room = 1 - cap * len(capped)
        over = {s for s, n in counts.items() if s not in capped and total and n * room > cap * rest * (1 + 1e-12)}
        if not over:
            break
        capped |= over
        if len(capped) == len(counts):
            break
    weights = {s: cap if s in capped else room * n / rest for s, n in counts.items()}
    scale = sum(weights.values())
    return {s: w / scale for s, w in weights.items()}


def quotas(counts: dict[str, int], weights: dict[str, float]) -> dict[str, int]:
    """Rows of each source in the largest mix that has the target weights."""
    size = min((counts.get(s, 0) / w for s, w in weights.items() if w > 0), default=0)
    return {s: min(n, int(weights.get(s, 0) * size + 1e-6)) for s, n in counts.items()}


def pfair_slots(blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of all blocks, slot by slot; holds one block of each source.

    Block j (from 0) of a source with b of all B blocks is released at floor(j B / b) and due at ceil((j + 1) B / b). In each slot the
    released block that is due first runs. As the blocks fill all slots, every block runs inside its window, so after any number of
    slots a source is less than one block away from its exact share.
    """
    total = sum(blocks.values())
    due: list[tuple[int, str, int, int]] = []
    coming = [(0, s, 0) for s, b in sorted(blocks.items()) if b]
    heapq.heapify(coming)
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            release, s, j = heapq.heappop(coming)
            heapq.heappush(due, (-(-(j + 1) * total // blocks[s]), s, j, release))
        deadline, s, j, release = heapq.heappop(due)
        assert slot < deadline
        yield s, j, release, deadline, slot
        if j + 1 < blocks[s]:
            heapq.heappush(coming, ((j + 1) * total // blocks[s], s, j + 1))


def pfair_period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of a whole schedule."""
    return [(s, j, slot) for s, j, _, _, slot in pfair_slots(shares)]


PLACE = ("block", "release", "deadline", "slot", "in_mix")


def schedule(starts: dict[str, list[tuple[int, int]]], parts: list[dict[str, int]]) -> tuple[pa.Table, int]:
    """The blocks of all sources as ranges of hashes (start_ to end_), cut where the buckets of their source end, and the number of slots.

    ``starts`` has (rank, hash) of the row at the start of each block. Hashes count from 0 upwards; a source with b blocks has as many
    buckets as the power of two below b, so there are at most twice as many rows as blocks, and some two blocks in each bucket.
    """
    slots = 0
    rows: dict[str, list[tuple[int, int, int, int, bool]]] = {s: [] for s in starts}
    before = dict.fromkeys(starts, 0)
    for k, blocks in enumerate(parts):
        for s, j, *times in pfair_slots(blocks):
            rows[s].append((before[s] + j, *(slots + t for t in times), k == 0))
        slots += sum(blocks.values())
        for s, b in blocks.items():
            before[s] = before.get(s, 0) + b
    tables = []
    for s, found in starts.items():
        if not rows[s]:
            continue
        first = np.array([h for _, h in sorted(found)], np.int64).astype(np.uint64) ^ np.uint64(1 << 63)
        first[0] = 0
        last = np.append(first[1:], np.uint64(2**64 - 1))
        bits = len(first).bit_length() - 1
        bucket = lambda h: (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)  # noqa: B023, E731
        low, high = bucket(first), bucket(np.maximum(last, first + np.uint64(1)) - np.uint64(1))
        at = np.repeat(np.arange(len(first)), high - low + 1)
        within = np.arange(len(at)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
        signed = lambda h: (h ^ np.uint64(1 << 63)).astype(np.int64)
        columns = [np.array(c)[at] for c in zip(*sorted(rows[s]), strict=True)]
        final = at == len(first) - 1
        tables.append(pa.table({"s_": pa.array([s] * len(at), pa.string()), "bits_": np.full(len(at), bits, np.int32), "bucket_": low[at] + within, "start_": signed(first[at]), "end_": pa.array(signed(last[at]), pa.int64(), mask=final), **dict(zip(PLACE, columns, strict=True))}))
    return pa.concat_tables(tables) if tables else None, slots


def _source(source_col: str) -> Column:
    return F.coalesce(F.col(source_col).cast("string"), F.lit(""))


def _hash(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Orders the rows of a source: of id and text, so that rows without an id, or of one id, still differ."""
    return F.xxhash64(id_col, *([text_col] if text_col in docs.columns else []))


def _planned(docs: DataFrame, weights: dict[str, float] | None, cap: float, block_rows: int | None, id_col: str, source_col: str, text_col: str) -> tuple[DataFrame, str, int]:
    """``docs`` with a struct of PLACE, null for rows without one; the name of that column; and the number of slots."""
    spark = docs.sparkSession
    slim = materialize(docs.select(_source(source_col).alias("source"), _hash(docs, id_col, text_col).alias("h_")), "mix")
    found = slim.groupBy("source").count().limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    counts = {r.source: r["count"] for r in found}
    block_rows = block_rows or max(8, -(-sum(counts.values()) // MOST_BLOCKS))
    target = weights or (capped_weights(counts, cap) if counts else {})
    quota = quotas(counts, target)
    left = {s: n - quota[s] for s, n in counts.items() if target.get(s, 0) > 0}
    parts = [{s: -(-q // block_rows) for s, q in part.items()} for part in (quota, left)]

    of_source = spark.createDataFrame([(s, q) for s, q in quota.items() if s in left], "source string, quota_ long")
    ranked = distributed_rank(slim, "source", ["h_"], "rank_", ranges="h_").join(F.broadcast(of_source), "source")
    since = F.when(F.col("rank_") < F.col("quota_"), F.col("rank_")).otherwise(F.col("rank_") - F.col("quota_"))
    starts: dict[str, list[tuple[int, int]]] = {s: [] for s in left}
    for r in ranked.where(since % block_rows == 0).select("source", "rank_", "h_").collect():  # one row a block
        starts[r.source].append((r.rank_, r.h_))
    table, slots = schedule(starts, parts)
    source, h, bits, bucket, place = fresh(docs, "source_", "hash_", "width_", "cell_", "place_")
    rows = docs.withColumns({source: _source(source_col), h: _hash(docs, id_col, text_col)})
    if table is None:
        return rows.withColumn(place, F.lit(None).cast("struct<block:long,release:long,deadline:long,slot:long,in_mix:boolean>")).drop(source, h), place, 0
    # Rows find their block by a hash join and a comparison of numbers, so texts stay where they are. Bounded: twice MOST_BLOCKS rows.
    names = dict(zip(("s_", "bits_", "bucket_", "start_", "end_"), fresh(rows, "s_", "bits_", "bucket_", "start_", "end_"), strict=True))
    blocks = spark.createDataFrame(table).withColumnsRenamed(names)
    blocks = blocks.select(*names.values(), F.struct(*PLACE).alias(place))
    n_bits = {s: len(x).bit_length() - 1 for s, x in starts.items() if x}
    widths = spark.createDataFrame(list(n_bits.items()), f"{names['s_']} string, {bits} int")
    rows = rows.join(F.broadcast(widths), F.col(source) == F.col(names["s_"]), "left").drop(names["s_"])
    cell = F.expr(f"CASE WHEN `{bits}` > 0 THEN shiftrightunsigned(`{h}` ^ {-(2**63) + 1}L ^ 1L, 64 - `{bits}`) ELSE 0L END")
    inside = (F.col(h) >= F.col(names["start_"])) & (F.col(names["end_"]).isNull() | (F.col(h) < F.col(names["end_"])))
    met = rows.withColumn(bucket, cell).join(F.broadcast(blocks), (F.col(source) == F.col(names["s_"])) & (F.col(bucket) == F.col(names["bucket_"])) & inside, "left")
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], place), place, slots


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, cap: float = 0.25, block_rows: int | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """A place in the mix for each row: id, source, in_mix, stream, block, release, deadline, slot.

    ``weights`` are target shares by source; by default the sources' own shares with none above ``cap``. The mix is the largest that
    has these shares without repeating a row: a source gives its quota of rows, in the order of a hash of their id and text, and in_mix
    is false for the rest. What is left then follows as a second mix, in which each source has its share of the rows left, so every row has
    a place and all sources end together. The rows of a source form blocks of ``block_rows`` (by default 8, or more, so that there are
    at most ``MOST_BLOCKS``), of which the last in either mix may be shorter; each gets a slot from the Pfair schedule of all blocks of
    its mix, so after any number of slots of a mix a source is less than one block away from its share of the blocks, however rare it
    is. Blocks, releases, deadlines and slots of the second mix count on from those of the first.

    The counts by source (``MOST_SOURCES`` at most, else an error) and the hash at the start of each block reach the driver; rows find
    their block by their hash, in a broadcast of the blocks. Ranks are found in buckets, so a source with a third of all rows is many
    tasks. A null source is a source of its own, named ''. Sources without a weight stay out: in_mix is false and they have no stream,
    block or slot. Rows without an id, or of one id, differ by their text (where there is such a column); rows that agree in both have
    one hash and so share a block. An empty table gives an empty result. Extra columns are ignored.
    """
    rows, place, _ = _planned(docs, weights, cap, block_rows, id_col, source_col, text_col)
    rows = rows.select(F.col(id_col), _source(source_col).alias("source"), F.col(place).alias("p_"))
    places = [F.col(f"p_.{c}").alias(c) for c in ("block", "release", "deadline", "slot")]
    return rows.select(id_col, "source", F.coalesce("p_.in_mix", F.lit(False)).alias("in_mix"), F.when(F.col("p_").isNotNull(), F.col("source")).alias("stream"), *places)


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, cap: float = 0.25, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", surplus: bool = False) -> DataFrame:
    """The rows of the mix with their columns, in the order of the schedule; with ``surplus`` those of the second mix after them.

    Partition k holds the k-th part of the slots, so rows move once and files written from the result follow the mix by their number.
    Nulls, repeated ids, sources without a weight and empty tables: as in :func:`mix_sources`.
    """
    rows, place, slots = _planned(docs, weights, cap, None, id_col, source_col, text_col)
    chosen = rows.where(F.col(place).isNotNull() if surplus else F.coalesce(F.col(place)["in_mix"], F.lit(False)))
    (slot,) = fresh(rows, "slot_")
    chosen = chosen.withColumn(slot, F.col(place)["slot"]).drop(place)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = F.floor(F.col(slot) * parts / max(1, slots)).cast("int")
    return chosen.repartitionById(parts, part).sortWithinPartitions(slot, id_col).select(*docs.columns)
