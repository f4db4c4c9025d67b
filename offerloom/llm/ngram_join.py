"""Exact Jaccard self-join on word shingles, by vertical partitioning of the global shingle order.

Shingles have one global order, rare ones first. The order is cut into fragments. Each document's shingles fall into these fragments,
overlaps are counted fragment by fragment for the candidate pairs, and the partial counts are summed per pair. Candidates share a
shingle of the part of the order that similar documents must share (the prefix), and pass a bound on their overlap from small
bitmaps of their sets. Components need not see all pairs of a group of copies: first each document is compared with the hubs of
its shared shingles, the most similar one before the others. Candidate pairs that are then still in different components are found
inside tasks, in blocks; each task passes on only as many of them as can join its components, until none is left.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import FILTER_BITS, bit_filter, connected_components, discard, materialize, tidy

#: Counters of the frequency sketch (4 bytes each) and of one message; fixed bounds.
COUNTERS, CHUNK = 1 << 20, 1 << 14
CACHED_WORDS = 50_000
FRAGMENTS = 4
#: Shingles of more documents than this, by the sketch, and of 8 times the mean counter are spread over SALTS tasks.
FREQUENT, SALTS = 100_000, 64
#: Bits at most of the bitmap of a document's set; it has one or two for each shingle.
MOST_BITS = 8192
#: Documents of one shingle, and partners of one document, that a task takes at once.
TILE, SPAN = 2048, 1000
#: Rounds in which a task passes on what can join its components; then it passes on all pairs that are left.
SPARSE_ROUNDS = 3


class Shingler:
    """Sets of 64-bit hashes of the ``width``-word shingles of texts given as UTF-8."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def words(self, text: bytes | None) -> list[bytes]:
        return (text or b"").lower().split()  # on bytes: A-Z only, and white space is space and 0x09 to 0x0D

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct hashes; fewer words than ``width`` are one shingle, no words none."""
        return self.shingles(self.word_hashes(words))

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            for x in words:
                if x not in known:
                    known[x] = xxhash.xxh64_intdigest(x)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, w: np.ndarray) -> np.ndarray:
        if not len(w):
            return w
        k = min(self.width, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = (h ^ w[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h.sort()
        return h if n == 1 else h[np.r_[True, h[1:] != h[:-1]]]


def _slices(batches, rows: int = 1000):
    """Batches in parts, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _ids_and_texts(batch):
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64, copy=False).view(np.int64)


def _bitmap(h: np.ndarray) -> bytes:
    """For each bit, the parity of the number of shingles that fall on it. Sets differ in at least as many shingles as their bitmaps in bits."""
    size = min(MOST_BITS, max(128, 1 << (len(h) - 1).bit_length() if len(h) else 0))
    return np.packbits((np.bincount(((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (the last axis, 64-bit words) as those of ``words`` words that the same sets have."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _profile(width: int):
    """doc_id, class of the word sequence (two longs), number of shingles, bitmap; at the end of a partition its part of the sketch."""
    names = ["doc", "c1", "c2", "n", "bits", "chunk", "counts"]

    def run(batches):
        s, counts = Shingler(width), np.zeros(COUNTERS, np.int64)
        for batch in _slices(batches):
            rows, seen = [], []
            for i, text in _ids_and_texts(batch):
                w = s.word_hashes(s.words(text))
                h = s.shingles(w)
                d = xxhash.xxh3_128_digest(w.tobytes())
                rows.append((i, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), len(h), _bitmap(h)))
                seen.append(h & np.uint64(COUNTERS - 1))
            if rows:
                counts += np.bincount(np.concatenate(seen).astype(np.int64), minlength=COUNTERS)
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names=names)
        for k in range(0, COUNTERS, CHUNK):
            if (part := counts[k : k + CHUNK]).any():
                packed = zlib.compress(part.tobytes(), 1)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.binary()), pa.array([k // CHUNK], pa.int32()), pa.array([packed], pa.binary())], names=names)

    return run


def _add_chunks(batches):
    """Sum the sketch parts of each chunk, one message at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in _ids_and_texts(batch):
            part = np.frombuffer(zlib.decompress(packed), np.int64)
            total[k] = total[k] + part if k in total else part
    for k, part in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])


class Order:
    """The global order: by sketched document frequency, then by hash, as one 64-bit key."""

    def __init__(self, counts: np.ndarray, fragments: int):
        self.counts = np.minimum(counts, (1 << 24) - 1).astype(np.uint32)
        self.frequent = max(FREQUENT, 8 * int(self.counts.mean()))
        c = np.sort(self.counts.astype(np.int64))
        mass, pivots = np.cumsum(c), []
        for f in range(1, fragments):
            target = mass[-1] * f // fragments
            v = c[min(np.searchsorted(mass, target), len(c) - 1)]
            low, high = int(mass[np.searchsorted(c, v)] - v), int(mass[np.searchsorted(c, v, "right") - 1])
            pivots.append((int(v) << 40) + int((target - low) / max(1, high - low) * ((1 << 40) - 1)))
        self.pivots = np.array(sorted(max(0, p) for p in pivots), np.uint64)

    def keys(self, h: np.ndarray) -> np.ndarray:
        c = self.counts[(h & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64)
        return (c << np.uint64(40)) | (h >> np.uint64(24))


def _prefixes(width: int, percent: int, order):
    """(sig, salt, doc, n, pos): the shingles of each document's prefix. Similar documents share one of these at least.

    salt is -1 but for shingles whose sketched frequency stands out, which it spreads by document.
    """

    def run(batches):
        s, o = Shingler(width), order.value
        for batch in _slices(batches):
            out = [[] for _ in range(5)]
            for i, text in _ids_and_texts(batch):
                h = s.hashes(s.words(text))
                n = len(h)
                if not n or i is None:
                    continue
                p = n - -(-percent * n // 100) + 1
                keys = o.keys(h)
                if p < n:
                    near = np.flatnonzero(keys <= np.partition(keys, p - 1)[p - 1])
                    h, keys = h[near], keys[near]
                first = np.lexsort((h, keys))[:p]
                often = (keys[first] >> np.uint64(40)) > o.frequent
                columns = (h[first].view(np.int64), np.where(often, i % SALTS, -1).astype(np.int32), np.full(p, i, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32))
                for c, x in zip(out, columns, strict=True):
                    c.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["sig", "salt", "doc", "n", "pos"])

    return run


def _repeated_of(percent: int):
    def run(batches):
        yield from _repeated(batches, percent)

    return run


def _repeated(batches, percent: int):
    """Of rows sorted by (sig, salt, n): those with a neighbour of the same sig that is not too short or long, and all with a salt.

    In order of length, a document without a near enough neighbour has no near enough document at all.
    """
    tail, matched = None, False  # the last row, which waits for the next batch, and if it had a neighbour before it
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if tail is None else pa.concat_tables([tail, t])
        sig, salt, n = (t.column(c).to_numpy() for c in ("sig", "salt", "n"))
        same = np.r_[matched, (sig[1:] == sig[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))]
        keep = same | np.r_[same[1:], False] | (salt >= 0)
        tail, matched = t.slice(len(t) - 1), bool(same[-1])
        yield from t.slice(0, len(t) - 1).filter(pa.array(keep[:-1])).combine_chunks().to_batches()
    if tail is not None and (matched or tail.column("salt")[0].as_py() >= 0):
        yield from tail.combine_chunks().to_batches()


def _segments(width: int, order, wanted):
    """(doc, frag, shingles): the segments of the documents whose id passes the filter."""

    def run(batches):
        s, o, bits = Shingler(width), order.value, wanted.value
        for batch in _slices(batches):
            ids, frags, segs = [], [], []
            for i, text in _ids_and_texts(batch):
                if i is None or not bits[(i % FILTER_BITS) >> 3] >> (i & 7) & 1:
                    continue
                h = s.hashes(s.words(text))
                f = np.searchsorted(o.pivots, o.keys(h), "right")
                for k in np.unique(f):
                    ids.append(i)
                    frags.append(int(k))
                    segs.append(_signed(h[f == k]))
            if ids:
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in segs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(frags, pa.int32()), pa.ListArray.from_arrays(offsets, np.concatenate(segs))], names=["doc", "frag", "shingles"])

    return run


def _sketch(spark: SparkSession, parts: DataFrame) -> np.ndarray:
    counts = np.zeros(COUNTERS, np.int64)
    for k, packed in parts.repartition("chunk").mapInArrow(_add_chunks, "chunk int, counts binary").collect():  # at most COUNTERS / CHUNK rows
        counts[k * CHUNK : (k + 1) * CHUNK] += np.frombuffer(zlib.decompress(packed), np.int64)
    return counts


def _bounded(percent: int):
    """Of pairs (a, b, na, nb, bits of a, bits of b) those that the bitmaps leave possible, with the number of bits that differ."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
            diff = np.empty(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                w = min(len(x), len(y))
                diff[k] = np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum()
            go = np.flatnonzero((100 + percent) * diff <= (100 - percent) * (na + nb))
            kept = [batch.column(k).take(pa.array(go)) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(diff[go])], names=["a", "b", "na", "nb", "diff"])

    return run


def _complete_groups(batches, keys: list[str]):
    """Tables that hold whole groups only, of batches sorted by ``keys``, with the ends of the groups."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        differs = np.zeros(len(t) - 1, bool)
        for c in keys:
            k = t.column(c).to_numpy()
            differs |= k[1:] != k[:-1]
        ends = np.flatnonzero(differs) + 1
        if len(ends):
            yield t.slice(0, ends[-1]), ends
            t = t.slice(ends[-1])
        rest = t
    if rest is not None and len(rest):
        yield rest, np.array([len(rest)])


def _crossing(percent: int, sparse: bool):
    """Of rows (sig, lo, hi, block, doc, n, pos, label, bits) sorted by (sig, lo, hi): pairs of one group that may be similar, with its sig.

    They have different labels and, where lo and hi differ, different blocks. ``sparse``: a pair is passed on only if no pairs
    before it join its labels, so there are fewer pairs than labels in a group; else all are. Pairs are made and tested in
    vectors as long as the batch, and those that fail never leave the task.
    """

    def run(batches):
        for t, ends in _complete_groups(batches, ["sig", "lo", "hi"]):
            doc, n, pos, label, block, lo, hi = (t.column(c).to_numpy().astype(np.int64) for c in ("doc", "n", "pos", "label", "block", "lo", "hi"))
            group = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            end, raw = ends[group], t.column("bits").to_pylist()
            width = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
            at = np.cumsum(width) - width
            words = np.frombuffer(b"".join(raw), np.uint64)
            _, code = np.unique(np.column_stack([group, label]), axis=0, return_inverse=True)
            code = code.ravel()
            root = np.arange(code.max() + 1)
            i, d, out = np.arange(len(doc)), 0, []
            while True:
                d += 1
                i = i[end[i] - i > d]
                if not len(i):
                    break
                j = i + d
                go = (root[code[i]] != root[code[j]]) & ((lo[i] == hi[i]) | (block[i] != block[j])) & (doc[i] != doc[j])
                x, y = i[go], j[go]
                less, more = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                room = 1 + np.minimum(n[x] - 1 - pos[x], n[y] - 1 - pos[y])
                go = (100 * less >= percent * more) & ((100 + percent) * room >= percent * (n[x] + n[y]))
                x, y = x[go], y[go]
                narrow = np.minimum(width[x], width[y])
                for w in np.unique(narrow):
                    for k in range(0, len(of := np.flatnonzero(narrow == w)), 4096):
                        u, v = x[of[k : k + 4096]], y[of[k : k + 4096]]
                        diff = np.bitwise_count(_rows(words, at, width, u, w) ^ _rows(words, at, width, v, w)).sum(1, dtype=np.int64)
                        near = (100 + percent) * diff <= (100 - percent) * (n[u] + n[v])
                        for p, q in zip(u[near].tolist(), v[near].tolist(), strict=True):
                            if sparse:
                                r, s = _top(root, code[p]), _top(root, code[q])
                                if r == s:
                                    continue
                                root[max(r, s)] = min(r, s)
                            out.append((p, q))
                if sparse:
                    while (root[root] != root).any():
                        root = root[root]
            if out:
                p, q = np.array(out).T
                p, q = np.where(doc[p] < doc[q], p, q), np.where(doc[p] < doc[q], q, p)
                sig = t.column("sig").to_numpy()[p]
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc[p]), pa.array(doc[q]), pa.array(n[p].astype(np.int32)), pa.array(n[q].astype(np.int32))], names=["sig", "a", "b", "na", "nb"])

    return run


def _top(root: np.ndarray, k: int) -> int:
    while root[k] != k:
        k = root[k]
    return k


def _rows(words: np.ndarray, at: np.ndarray, width: np.ndarray, rows: np.ndarray, w: int) -> np.ndarray:
    """The bitmaps of ``rows``, all folded to ``w`` words."""
    out = np.empty((len(rows), w), np.uint64)
    for own in np.unique(width[rows]):
        of = np.flatnonzero(width[rows] == own)
        out[of] = _fold(words[at[rows[of]][:, None] + np.arange(own)], w)
    return out


def _overlaps(batches):
    """(a, b, frag, na, nb, o) of rows sorted by (a, salt, frag, b): the shingles of a, then those of each of its partners b."""
    key = mine = None
    for batch in batches:
        out = [[] for _ in range(6)]
        arrays = batch.column("shingles")
        starts, values = arrays.offsets.to_numpy(), arrays.values.to_numpy()
        for k, (a, salt, frag, b, na, nb) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "frag", "b", "na", "nb")), strict=True)):
            shingles = values[starts[k] : starts[k + 1]]
            if b is None:
                key, mine = (a, salt, frag), shingles.copy()
            elif key == (a, salt, frag):
                o = len(np.intersect1d(mine, shingles, assume_unique=True))
                for col, v in zip(out, (a, b, frag, na, nb, o), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()], strict=True)], names=["a", "b", "frag", "na", "nb", "o"])


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for every row of ``docs``.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their shingle sets. class_id is the smallest id with the same
    word sequence, component_id the smallest id reachable by links. A null text counts as empty; documents without words have no
    shingles and are their own component. Rows without an id have n_shingles and no component. Rows that repeat an id must repeat
    its text. An empty table gives an empty result; extra columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"))
    profile = materialize(texts.mapInArrow(tidy(_profile(width)), "doc long, c1 long, c2 long, n long, bits binary, chunk int, counts binary"), "profile")
    rows = profile.where("chunk is null").select("doc", "c1", "c2", "n")
    bits = profile.where("chunk is null and n > 0").select("doc", "bits")
    order = spark.sparkContext.broadcast(Order(_sketch(spark, profile.where("chunk is not null").select("chunk", "counts")), FRAGMENTS))
    rep = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("doc").alias("rep"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("m"))
    copies = rows.where("n > 0").join(rep.where("rep < last"), ["c1", "c2"]).where("doc <> rep").select("doc", "rep").distinct()
    copies = materialize(copies, "copies")

    # Shingles of prefixes that two documents share. Of equal word sequences only the first document's rows stay.
    sigs = texts.mapInArrow(tidy(_prefixes(width, percent, order)), "sig long, salt int, doc long, n int, pos int")
    again = sigs.repartition("sig", "salt").sortWithinPartitions("sig", "salt", "n").mapInArrow(tidy(_repeated_of(percent)), sigs.schema)
    shared = materialize(again.join(copies.select("doc"), "doc", "left_anti").select("sig", "doc", "n", "pos"), "shared")

    def verify(pairs: DataFrame) -> DataFrame:
        """The links among the pairs (a, b, na, nb): partial overlaps by fragment, summed per pair.

        Only documents of these pairs (and those that share their bit of the filter) are cut into segments. The segments of b go to
        those of a, which are there once for SPAN partners.
        """
        ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
        wanted = spark.sparkContext.broadcast(bit_filter(ids.select(F.pmod("doc", F.lit(FILTER_BITS)).alias("slot")), "slot"))
        segments = materialize(texts.mapInArrow(tidy(_segments(width, order, wanted)), "doc long, frag int, shingles array<long>"), "segments")
        spans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SPAN).alias("spans"))
        partners = pairs.join(spans, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("spans")))
        theirs = partners.join(segments, partners["b"] == segments["doc"]).select("a", "salt", "frag", "b", "na", "nb", "shingles")
        none = F.lit(None)
        of_a = partners.select("a", "salt").distinct().join(segments, F.col("a") == F.col("doc"))
        of_a = of_a.select("a", "salt", "frag", none.cast("long").alias("b"), none.cast("int").alias("na"), none.cast("int").alias("nb"), "shingles")
        met = of_a.unionByName(theirs).repartition("a", "salt", "frag").sortWithinPartitions("a", "salt", "frag", F.asc_nulls_first("b"))
        part = met.mapInArrow(tidy(_overlaps), "a long, b long, frag int, na int, nb int, o long")
        part = part.groupBy("a", "b", "frag", "na", "nb").agg(F.max("o").alias("o"))  # rows that repeat an id give the same count
        total = part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
        enough = (100 + percent) * F.col("o") >= percent * (F.col("na").cast("long") + F.col("nb"))
        links = materialize(total.where(enough).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        discard(segments)
        wanted.destroy()
        return links

    def apart(pairs: DataFrame) -> DataFrame:
        """The pairs whose documents are in different components so far."""
        of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
        both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select(*pairs.columns)

    links = spark.createDataFrame([], "u long, v long")
    labels = spark.createDataFrame([], "node long, component long")

    # Each document against the hubs (the smallest ids) of its shingles: first the hub that its bitmap is nearest to.
    hubs = shared.groupBy("sig").agg(F.min(F.struct("doc", "n", "pos")).alias("hub"))
    met = shared.join(hubs, "sig").where("doc <> hub.doc")
    na, nb, pa_, pb = (F.col(c).cast("long") for c in ("hub.n", "n", "hub.pos", "pos"))
    room = F.lit(1) + F.least(na - 1 - pa_, nb - 1 - pb)  # the overlap that is still possible from this shingle on
    possible = (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * room >= percent * (na + nb))
    pairs = met.where(possible).select(F.col("hub.doc").alias("a"), F.col("doc").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb")).distinct()
    with_bits = pairs.join(bits.select(F.col("doc").alias("a"), F.col("bits").alias("bits_a")), "a").join(bits.select(F.col("doc").alias("b"), F.col("bits").alias("bits_b")), "b")
    near = with_bits.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(tidy(_bounded(percent)), "a long, b long, na int, nb int, diff long")
    near = materialize(near, "near")
    first = near.groupBy("b").agg(F.min(F.struct("diff", "a", "na", "nb")).alias("x")).select("x.a", "b", "x.na", "x.nb")
    tested = near.select("a", "b")
    for todo in (first, near.drop("diff").distinct()):
        todo = materialize(apart(todo), "pairs")
        if not todo.isEmpty():
            links = links.unionByName(verify(todo))
            labels = materialize(connected_components(links), "labels")

    # What shares a shingle and is still apart, in blocks. Shingles that give no pair in one round are done.
    k, active_sigs = 0, shared
    while k <= SPARSE_ROUNDS:
        labelled = active_sigs.join(labels, F.col("doc") == F.col("node"), "left").select("sig", "doc", "n", "pos", F.coalesce("component", "doc").alias("label"))
        split = labelled.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.ceil(F.count(F.lit(1)) / TILE).alias("blocks")).where("x < y").select("sig", "blocks")
        active = labelled.join(split, "sig").withColumn("block", F.pmod(F.xxhash64("doc", F.lit(k)), F.col("blocks"))).join(bits, "doc")
        tiled = active.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        tiled = tiled.select("sig", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "doc", "n", "pos", "label", "bits")
        tiled = tiled.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi", *(["n"] if k == 0 else []), F.xxhash64("doc", F.lit(k)))
        crossing = materialize(tiled.mapInArrow(tidy(_crossing(percent, k < SPARSE_ROUNDS)), "sig long, a long, b long, na int, nb int"), "crossing")
        if crossing.isEmpty():
            break
        todo = materialize(crossing.drop("sig").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        active_sigs = materialize(active_sigs.join(crossing.select("sig").distinct(), "sig", "left_semi"), "active")
        if todo.isEmpty():  # nothing new: what is left are pairs that failed and those they hid
            k = max(k + 1, SPARSE_ROUNDS)
            continue
        k += 1
        tested = tested.unionByName(todo.select("a", "b"))
        links = links.unionByName(verify(todo))
        labels = materialize(connected_components(links), "labels")

    discard(shared)
    order.destroy()
    out = rows.join(copies, "doc", "left").withColumn("class_id", F.coalesce("rep", "doc"))
    out = out.join(labels, out["class_id"] == labels["node"], "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays (the one with the smallest id), with its columns.

    Documents without words stay, and rows without an id. Rows that repeat an id must repeat its text, and all stay or go. An
    empty table gives an empty result.
    """
    gone = jaccard_components(docs, id_col, text_col, width, percent).where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(materialize(gone, "gone"), id_col, "left_anti").select(*docs.columns)
