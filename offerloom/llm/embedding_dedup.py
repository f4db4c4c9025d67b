"""Near-dedup of embeddings by PCA-ordered tiled comparison.

Vectors are turned onto the principal axes of all vectors, so leading dimensions carry most of a product. They are dealt into tiles
along the first axis. Two tiles are compared block by block: the product of the leading dimensions plus the product of the norms of
the rest is an upper bound of the cosine; pairs whose bound stays below the threshold are dropped, the others get more dimensions,
and what is left is decided by the full product in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import connected_components, distributed_rank, forest, materialize

BLOCK = 512  # rows of a tile that are compared at once
STRIPS = 128  # ranges of the first axis at most
BUNDLE_BYTES = 128 << 20  # of the tiles that travel together, at most
LEAST_BUNDLES = 16  # with as many tiles or more: enough pairs of bundles for the tasks, and few enough copies of each tile
SLACK = 1e-4  # more than single precision can be off in a bound


def _clean(batches):
    """vec_id, length and key of the vector (null for vectors that link with nothing) and the vector as bytes.

    Vectors are divided by a power of two, which is exact and keeps squares of very large and very small components in range.
    """
    for batch in batches:
        ids, dims, k1, k2, raw = [], [], [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = None
            if v and None not in v and i is not None:
                x = np.array(v, np.float64) + 0.0  # -0.0 becomes 0.0
                top = np.abs(x).max()
                x = np.ldexp(x, -int(np.frexp(top)[1])) + 0.0 if 0 < top < np.inf else None
            b = None if x is None else x.tobytes()
            d = None if b is None else xxhash.xxh3_128_digest(b)
            ids.append(i)
            dims.append(None if b is None else len(x))
            k1.append(None if d is None else int.from_bytes(d[:8], "big", signed=True))
            k2.append(None if d is None else int.from_bytes(d[8:], "big", signed=True))
            raw.append(b)
        columns = [pa.array(c, t) for c, t in ((ids, pa.int64()), (dims, pa.int32()), (k1, pa.int64()), (k2, pa.int64()), (raw, pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "k1", "k2", "raw"])


def _unit(raw) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _moments(dim: int, partial: bool):
    """The sum of u u' over the unit vectors of a partition (or, if ``partial``, of such sums), as one row."""

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            if partial:
                for s in batch.column(0).to_pylist():
                    total += np.frombuffer(s).reshape(dim, dim)
            elif batch.num_rows:
                u = _unit(batch.column(0).to_pylist())
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    return run


def _project(axis: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                u = _unit(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(u @ axis)], names=["vec", "m", "raw", "pc"])

    return run


def _pack_tile(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"strip": [int(pdf.strip.iloc[0])], "part": [int(pdf.part.iloc[0])], "ids": [pdf.vec.to_numpy(np.int64).tobytes()], "counts": [pdf.m.to_numpy(np.int64).tobytes()], "vectors": [b"".join(pdf.raw)], "low": [pdf.pc.min()], "high": [pdf.pc.max()]})


class _Tile:
    def __init__(self, row, axes, cuts):
        ids, counts, vectors = (row[c] for c in ("ids", "counts", "vectors"))
        self.low, self.high = row["low"], row["high"]
        self.ids, self.counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64)
        x = np.frombuffer(vectors, np.float64).reshape(len(self.ids), -1)
        self.raw, self.norm = x, np.sqrt((x * x).sum(1))
        turned = (x / self.norm[:, None]) @ axes
        self.rest = [np.sqrt(np.maximum(0, (turned[:, c:] ** 2).sum(1))) for c in cuts]
        self.turned = turned.astype(np.float32)
        self.lead = np.column_stack([turned[:, : cuts[0]], self.rest[0]]).astype(np.float32)  # its product is the first bound


def _links(a: _Tile, b: _Tile, same: bool, cuts, threshold: float):
    """Index pairs (i in a, j in b) with a cosine of at least ``threshold``; within a tile i < j."""
    for i0 in range(0, len(a.ids), BLOCK):
        bound = a.lead[i0 : i0 + BLOCK] @ b.lead.T
        i, j = np.nonzero(bound >= threshold - SLACK)
        part = bound[i, j].astype(np.float64)
        i += i0
        if same:
            part, i, j = part[i < j], i[i < j], j[i < j]
        part -= a.rest[0][i] * b.rest[0][j]
        for k in range(1, len(cuts)):
            part += np.einsum("ij,ij->i", a.turned[i, cuts[k - 1] : cuts[k]], b.turned[j, cuts[k - 1] : cuts[k]])
            go = part + a.rest[k][i] * b.rest[k][j] >= threshold - SLACK
            part, i, j = part[go], i[go], j[go]
        for at in range(0, len(i), 200_000):
            x, y = i[at : at + 200_000], j[at : at + 200_000]
            full = np.einsum("ij,ij->i", a.raw[x], b.raw[y]) / (a.norm[x] * b.norm[y])
            yield x[full >= threshold], y[full >= threshold]


def _compare(axes: np.ndarray, cuts: list[int], threshold: float):
    """(vec, n, low) of rows sorted by (ba, bb, side): bundles of tiles (side 0 first) that are compared with each other.

    For each vector with links in a pair of tiles their number and the smallest vector it is connected to. A task holds the tiles of
    one bundle; those of the other come one by one. In a bundle that meets itself each tile meets those before it and itself.
    """
    reach = (2 - 2 * threshold) ** 0.5 + SLACK

    def pair(a: _Tile, b: _Tile):
        na, nb = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        u, v = np.empty(0, np.int64), np.empty(0, np.int64)
        for x, y in _links(a, b, a is b, cuts, threshold):
            if len(x):
                na += np.bincount(x, weights=b.counts[y], minlength=len(na)).astype(np.int64)
                nb += np.bincount(y, weights=a.counts[x], minlength=len(nb)).astype(np.int64)
                u, v = forest(np.concatenate([u, a.ids[x]]), np.concatenate([v, b.ids[y]]))
        if len(u):
            ids, n = np.concatenate([a.ids, b.ids]), np.concatenate([na, nb])
            ids, n = ids[n > 0], n[n > 0]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(v[np.searchsorted(u, ids)])], names=["vec", "n", "low"])

    def run(batches):
        key, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if key != (row["ba"], row["bb"]):
                    key, held = (row["ba"], row["bb"]), []
                tile = _Tile(row, axes, cuts)
                if row["side"] == 0:
                    held.append(tile)
                if row["side"] == 1 or row["ba"] == row["bb"]:
                    for other in held:
                        if max(tile.low, other.low) - min(tile.high, other.high) <= reach:
                            yield from pair(other, tile)

    return run


def embedding_near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, tile_rows: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    n_links counts the other rows with a cosine of at least ``threshold``, component_id is the smallest id reachable by links, kept
    says that it is the row's own. All rows of equal length are compared. Equal vectors are one class with a count, so a vector that a
    third of all rows share is compared once and its links are counted by multiplying. Tiles have at most ``tile_rows`` classes;
    tiles travel in bundles, so a tile is sent once for each bundle it meets. Pairs of tiles whose ranges on the first axis are too far
    apart for any link are not compared. No pair leaves a task: each pair of tiles gives, per vector, a count and one link.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different lengths don't
    link with each other. Rows that repeat an id count as rows; a null id gives null and kept false, and links with nothing. An empty
    table gives an empty result. Extra columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    keyed = materialize(rows.mapInArrow(_clean, "vec_id long, dim int, k1 long, k2 long, raw binary"), "vectors")
    classes = keyed.where("k1 is not null").groupBy("dim", "k1", "k2").agg(F.min("vec_id").alias("vec"), F.count(F.lit(1)).alias("m"), F.first("raw").alias("raw"))
    classes = materialize(classes.withColumn("number", F.monotonically_increasing_id()), "classes")  # two classes may have one id
    found = None
    for r in classes.groupBy("dim").count().where("count > 1").collect():  # a row for each length
        of_dim = _links_of(classes.where(F.col("dim") == r.dim).select(F.col("number").alias("vec"), "m", "raw"), r.dim, threshold, tile_rows)
        found = of_dim if found is None else found.unionByName(of_dim)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "vec long, n long, low long")

    labels = connected_components(found.select(F.col("vec").alias("u"), F.col("low").alias("v")))
    direct = found.groupBy("vec").agg(F.sum("n").alias("n"))
    of_class = classes.select("k1", "k2", "m", F.col("vec").alias("id"), "number").join(direct, F.col("number") == F.col("vec"), "left").join(labels, F.col("number") == F.col("node"), "left")
    of_class = of_class.select("k1", "k2", "id", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "number").alias("label"))
    of_class = of_class.join(of_class.groupBy("label").agg(F.min("id").alias("c")), "label").drop("label", "id")
    out = keyed.select("vec_id", "k1", "k2").join(of_class, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def tiles_together(n_tiles: int, tile_bytes: int) -> int:
    """The tiles of a bundle. A tile is sent once for each bundle, so bundles are LEAST_BUNDLES, until BUNDLE_BYTES call for more."""
    return max(1, min(BUNDLE_BYTES // tile_bytes, -(-n_tiles // LEAST_BUNDLES)))


def _links_of(classes: DataFrame, dim: int, threshold: float, tile_rows: int) -> DataFrame:
    """(vec, n, low) for the classes (vec, m, raw) of one length: see :func:`_compare`."""
    sums = classes.select("raw").mapInArrow(_moments(dim, False), "s binary").repartition(8).mapInArrow(_moments(dim, True), "s binary").collect()  # 8 rows
    moment = sum(np.frombuffer(r.s).reshape(dim, dim) for r in sums)
    axes = np.linalg.eigh(moment)[1][:, ::-1]
    cuts = sorted({max(1, dim // 4), max(1, dim // 2), dim})

    placed = materialize(classes.mapInArrow(_project(axes[:, 0]), "vec long, m long, raw binary, pc double"), "placed")
    n_strips = min(STRIPS, -(-placed.count() // tile_rows))
    edges = sorted(set(placed.approxQuantile("pc", [k / n_strips for k in range(1, n_strips)], 0.1 / n_strips))) if n_strips > 1 else []
    strip = F.lit(0)
    for e in edges:
        strip = strip + (F.col("pc") >= e).cast("int")
    ranked = distributed_rank(placed.withColumn("strip", strip), "strip", ["vec"], "rank_")
    numbered = ranked.withColumn("part", F.floor(F.col("rank_") / tile_rows).cast("long"))
    tiles = numbered.groupBy("strip", "part").applyInPandas(_pack_tile, "strip int, part long, ids binary, counts binary, vectors binary, low double, high double")
    tiles = materialize(tiles, "tiles")

    # Tiles are numbered along the first axis (at most STRIPS counts come to the driver), and neighbours share a bundle, across strips.
    sizes = {r.strip: r.n for r in tiles.groupBy("strip").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = F.array(*[F.lit(sum(n for t, n in sizes.items() if t < k)).cast("long") for k in range(max(sizes) + 1)])
    together = tiles_together(sum(sizes.values()), 8 * dim * tile_rows)
    tiles = tiles.withColumn("bundle", F.floor((F.element_at(before, F.col("strip") + 1) + F.col("part")) / together).cast("long"))

    # Pairs of bundles within reach of each other; the lower number is the lower one on the axis.
    reach = (2 - 2 * threshold) ** 0.5 + SLACK
    span = materialize(tiles.groupBy("bundle").agg(F.min("low").alias("low"), F.max("high").alias("high")), "spans")
    a, b = (span.select(*[F.col(c).alias(c[0] + side) for c in ("bundle", "low", "high")]) for side in "ab")
    pairs = a.join(b, (F.col("ba") <= F.col("bb")) & (F.col("lb") - F.col("ha") <= reach)).select("ba", "bb")
    content = ["ids", "counts", "vectors", "low", "high"]
    first = pairs.join(tiles, F.col("ba") == F.col("bundle")).select("ba", "bb", F.lit(0).alias("side"), *content)
    second = pairs.where("ba < bb").join(tiles, F.col("bb") == F.col("bundle")).select("ba", "bb", F.lit(1).alias("side"), *content)
    met = first.unionByName(second).repartition("ba", "bb").sortWithinPartitions("ba", "bb", "side")
    return materialize(met.mapInArrow(_compare(axes, cuts, threshold), "vec long, n long, low long"), "found")
