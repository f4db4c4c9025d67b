"""Vector code compression: each vector becomes one codebook index a part, learned in exact integers.

Parts and codebook entries are padded with zeros to a power of two and put through an integer Walsh-Hadamard transform, which
multiplies every squared distance by that power of two and gathers most of it in the first coefficients of the sequency order.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import join_by_frequency, materialize, tidy

SCALE = 4096
#: Rows of one block of distances: bounds the memory of a task.
ROWS = 4096


def sequency_order(n: int) -> np.ndarray:
    """The rows of the Hadamard matrix of size ``n`` (a power of two) by their number of sign changes."""
    i = np.arange(n)
    signs = np.array([[bin(a & b).count("1") & 1 for b in i] for a in i])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def hadamard(parts: np.ndarray) -> np.ndarray:
    """Integer transform of the last axis, padded with zeros to a power of two, in sequency order."""
    n = 1 << max(0, parts.shape[-1] - 1).bit_length()
    x = np.zeros((*parts.shape[:-1], n), np.int64)
    x[..., : parts.shape[-1]] = parts
    h = 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x[..., sequency_order(n)]


def nearest(parts: np.ndarray, entries: np.ndarray, first: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``entries`` (ties: the lower) for each row of ``parts``, and the squared distance.

    Scaled squared differences are added up over the coefficients. After the first ones, the entry that is nearest so far is worked
    out in full; what exceeds its distance already is out. The rest goes on in doubling steps, and is compared again after each.
    """
    x, c = hadamard(parts), hadamard(entries)
    n, size = x.shape
    first = min(first, size)
    partial = np.zeros((n, len(c)), np.int64)
    for k in range(first):
        partial += (x[:, k, None] - c[None, :, k]) ** 2
    rows = np.arange(n)
    seed = partial.argmin(axis=1)
    bound = partial[rows, seed] + ((x[:, first:] - c[seed, first:]) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    k = first
    while k < size:
        end = min(size, 2 * k)
        total = total + ((x[row, k:end] - c[entry, k:end]) ** 2).sum(axis=1)
        left = total <= bound[row]
        row, entry, total, k = row[left], entry[left], total[left], end
    low = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(low, row, total)
    best = np.full(n, len(c))
    at = total == low[row]
    np.minimum.at(best, row[at], entry[at])
    return best, low // size


def _blocks(batch: pa.RecordBatch, width: int):
    for k in range(0, batch.num_rows, ROWS):
        part = batch.slice(k, ROWS)
        yield part, part.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _sums(books: np.ndarray):
    """A task's rows to (part, entry, at, total, n): sums of the parts that fall to each entry."""
    parts, entries, width = books.shape

    def run(batches):
        total, n = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, q in _blocks(batch, parts * width):
                for p in range(parts):
                    x = q[:, p * width : (p + 1) * width]
                    code, _ = nearest(x, books[p])
                    np.add.at(total[p], code, x)
                    n[p] += np.bincount(code, minlength=entries)
        p, e, at = (i.ravel() for i in np.indices(books.shape))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(at), pa.array(total.ravel()), pa.array(np.repeat(n.ravel(), width))], names=["part", "entry", "at", "total", "n"])

    return tidy(run)


def _codes(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            for rows, q in _blocks(batch, parts * width):
                code, error = np.zeros((len(q), parts), np.uint8), np.zeros(len(q), np.int64)
                for p in range(parts):
                    code[:, p], e = nearest(q[:, p * width : (p + 1) * width], books[p])
                    error += e
                yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return tidy(run)


def learn_codebooks(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, position) of ``rows`` (vec_id, q): the first ids' parts, then ``rounds`` of assignment and integer means.

    What comes to the driver each round are parts x entries x width sums.
    """
    ids = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    seeds = rows.join(F.broadcast(ids.withColumnRenamed("vec_id", "id_")), F.col("vec_id").eqNullSafe(F.col("id_"))).groupBy("vec_id").agg(F.min("q").alias("q"))
    first = seeds.orderBy(F.col("vec_id").asc_nulls_last()).collect()  # ``entries`` rows at most
    start = np.array([r.q for r in first], np.int64)
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = rows.select("q").mapInArrow(_sums(books), "part long, entry long, at long, total long, n long")
        sums = sums.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in sums.where("n > 0").collect():
            books[r.part, r.entry, r.at] = int(r.total) // r.n
    return books


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector without null or non-finite components; others drop out.

    A component x becomes floor(4096 x); vectors are cut into ``parts`` equal parts. Codebooks start as the parts of the ``entries``
    smallest ids (an id that repeats counts once, by its least vector; null comes last; with fewer ids, fewer entries), then ``rounds``
    of nearest entries and integer means follow. error is the squared distance to the final entries, label_error its sum over equal
    labels, nulls together. At most 256 entries fit the code's two hex digits.

    The integers are written once; each round reads them and passes on one sum for each component of the codebooks and task.

    Shorter vectors count as padded with zeros to the longest length, and all to a multiple of ``parts``. Repeated rows are rows each.
    An empty table, or one without a whole vector, gives an empty result. Components too large for exact 64-bit sums (46,340 with
    parts of 8) raise an error that names them. Extra columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    whole = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = v.where(F.coalesce(whole, F.lit(False)))
    size = v.agg(F.max(F.size("v")).alias("length"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    width = -(-max(1, size.length or 0) // parts)
    padded = 1 << (width - 1).bit_length()
    if (size.largest or 0) * SCALE >= min(1 << 31, math.isqrt((1 << 61) // padded**2)):
        raise ValueError(f"a component of {size.largest:g} is too large for exact sums")
    scaled = F.transform("v", lambda x: F.floor(x * SCALE).cast("int"))
    zeros = F.array_repeat(F.lit(0), F.lit(width * parts) - F.size("v"))
    rows = materialize(v.select("vec_id", "label", F.concat(scaled, zeros).alias("q")), "integers")
    if size.length is None:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
        return empty.limit(0)
    books = learn_codebooks(rows, width, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kinds = dict(rows.dtypes)
    codes = materialize(rows.mapInArrow(_codes(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    sums = materialize(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "sums")
    return join_by_frequency(codes, sums, "label", "n").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same in SQL: one pair of expressions a round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS MATERIALIZED (SELECT vec_id, part, any_value(x) AS x, min(dist * {entries} + entry) AS best FROM (
            SELECT vec_id, p.part, entry, x, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS dist FROM p JOIN c{k} ON p.part = c{k}.part) GROUP BY vec_id, part)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT part, best % {entries} AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM d{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS i) GROUP BY ALL),
        u{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{k} GROUP BY ALL),
        c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(u{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN u{k} USING (part, entry))""")
    return f"""
        WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT vec_id, j AS part, q[j * (len(q) // {parts}) + 1 : (j + 1) * (len(q) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS j)),
        c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}),
        {", ".join(steps)},
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}),
        e AS (SELECT vec_id, string_agg(lower(printf('%02x', best % {entries})), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM d{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM e JOIN kept USING (vec_id), h"""
