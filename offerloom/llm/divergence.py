"""Source divergence audit: how the words of each source differ from those of the others of its language.

Term counts of a language are cut into blocks of terms. In a block each source's counts are a segment tree over the term ids, whose
equal subtrees are one node (hash-consed); two trees are walked together level by level, and a pair of nodes that occurs again in
the walk is one entry with a multiplicity, so it is priced once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.llm.common import materialize, tidy

SCALE = 1_000_000_000
#: Bytes of terms: letters, A-Z as a-z, and all of code points beyond ASCII; 0 for what separates terms.
LETTERS = np.array([c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)
#: Bytes of text that are counted at once (one document at least), and (group, term) counts that a task holds before it passes them on.
SLICE, HELD = 4 << 20, 400_000
#: Counts in a block, sources in a tile, and pairs of nodes that are walked at once: they bound the memory of a task.
BLOCK, TILE, FRONTIER = 1 << 16, 256, 1 << 19

COUNTS = "lang string, source string, term binary, n long, docs long"
PRICES = "lang string, source string, part string, item string, value long"


def _slice_counts(text: pa.Array, group: np.ndarray, ends: np.ndarray) -> pa.Table:
    """Occurrences and documents of each (group, term) in texts that lie one after the other; ``ends`` are their bounds in the buffer."""
    first = int(ends[0])
    letters = LETTERS[np.frombuffer(text.buffers()[2] or b"", np.uint8)[first : int(ends[-1])]]
    bounds = (ends - first).astype(np.int64)
    inside = letters != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(letters)]
    begins[heads] = inside[heads]  # a term ends with its text
    starts = np.flatnonzero(begins)
    packed = letters[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(packed)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    code, k = words.indices.to_numpy(), max(1, len(words.dictionary))
    doc = np.searchsorted(bounds, starts, "right") - 1
    of_doc, times = np.unique(doc * k + code, return_counts=True)
    of_group, at = np.unique(group[of_doc // k] * k + of_doc % k, return_inverse=True)
    total = np.zeros(len(of_group), np.int64)
    np.add.at(total, at, times)
    terms = words.dictionary.take(pa.array(of_group % k)).cast(pa.binary())
    return pa.table({"g": of_group // k, "term": terms, "n": total, "docs": np.bincount(at, minlength=len(of_group)).astype(np.int64)})


def count_terms(batches):
    """(lang, source, text) to counts of (lang, source, term); the empty term stands for the documents of a group."""
    groups: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        t = pa.concat_tables(held).group_by(["g", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return pa.table({"g": t["g"], "term": t["term"], "n": t["n_sum"], "docs": t["docs_sum"]})

    def passed_on(t: pa.Table):
        lang, source = (pa.array([key[i] for key in groups], pa.string()) for i in range(2))
        for b in t.combine_chunks().to_batches(max_chunksize=20_000):
            g = b.column(0)
            yield pa.RecordBatch.from_arrays([lang.take(g), source.take(g), b.column(1), b.column(2), b.column(3)], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        group = np.array([groups.setdefault(key, len(groups)) for key in keys], np.int64)
        text = batch.column(2)
        offset = np.frombuffer(text.buffers()[1], np.int64 if pa.types.is_large_binary(text.type) else np.int32)[text.offset : text.offset + len(text) + 1]
        n = np.bincount(group, minlength=len(groups))
        at = np.flatnonzero(n)
        held.append(pa.table({"g": at, "term": pa.array([b""] * len(at), pa.binary()), "n": np.zeros(len(at), np.int64), "docs": n[at].astype(np.int64)}))
        k = 0
        while k < len(text):
            end = max(k + 1, int(np.searchsorted(offset, offset[k] + SLICE, "right")) - 1)
            held.append(_slice_counts(text, group[k:end], offset[k : end + 1]))
            k = end
            if sum(t.num_rows for t in held) > HELD:
                held = [merged()]
                if held[0].num_rows > HELD // 2:
                    yield from passed_on(held[0])
                    held = []
    if held:
        yield from passed_on(merged())


def shares(counts: np.ndarray, size: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / size), exact at any count."""
    if len(counts) and int(counts.max()) >= 2**63 // SCALE - 1:
        return np.array([1 + SCALE * (int(c) + 1) // size for c in counts.ravel()], np.int64).reshape(counts.shape)
    return 1 + SCALE * (counts + 1) // size


def consed_trees(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Segment trees of the rows of ``counts`` (their number of columns a power of two), in which equal subtrees are one node.

    Returns the distinct leaves, for each level from the leaves up the children (left, right) of its nodes, and the root of each row.
    """
    leaves, ids = np.unique(counts, return_inverse=True)
    ids, levels = ids.reshape(counts.shape).astype(np.int64), []
    while ids.shape[1] > 1:
        k = int(ids.max()) + 1
        nodes, up = np.unique(ids[:, 0::2] * k + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // k, nodes % k))
        ids = up.reshape(len(ids), -1)
    return leaves, levels, ids[:, 0]


def price_pairs(counts: np.ndarray, sizes: list[int], first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows of ``counts`` (-1: no term) the summed floor((p - q)^2 / q), with the second's share as q, and with the first's."""
    leaves, levels, roots = consed_trees(counts)
    share = np.array([shares(np.maximum(leaves, 0), s) for s in sizes])
    there = (leaves >= 0).astype(np.int64)
    out = np.zeros((2, len(first)), np.int64)
    step = max(1, FRONTIER // counts.shape[1])
    for k in range(0, len(first), step):
        s, t = first[k : k + step], second[k : k + step]
        pair, a, b, times = np.arange(len(s)), roots[s], roots[t], np.ones(len(s), np.int64)
        for left, right in reversed(levels):
            n = int(max(left.max(), right.max())) + 1
            key = (np.tile(pair, 2) * n + np.r_[left[a], right[a]]) * n + np.r_[left[b], right[b]]
            key, at = np.unique(key, return_inverse=True)
            twice, times = np.tile(times, 2), np.zeros(len(key), np.int64)
            np.add.at(times, at, twice)
            pair, a, b = key // (n * n), key // n % n, key % n
        p, q = share[s[pair], a], share[t[pair], b]
        gap = (p - q) ** 2
        times = times * there[a]
        starts = np.searchsorted(pair, np.arange(len(s)))
        out[0, k : k + step] = np.add.reduceat(gap // q * times, starts)
        out[1, k : k + step] = np.add.reduceat(gap // p * times, starts)
    return out[0], out[1]


def price_block(table: pa.Table, most: int) -> pa.Table:
    """Prices of one block of terms: of all pairs of sources of two tiles, and the ``most`` dearest terms of each source (and their ties)."""
    is_head = pc.is_valid(table["groups"])
    head = table.filter(is_head).slice(0, 1).to_pylist()[0]
    rows = table.filter(pc.invert(is_head)).sort_by([("total", "descending"), ("term", "ascending")]).combine_chunks()
    names, sizes = [g["source"] for g in head["groups"]], [g["size"] + head["v"] for g in head["groups"]]
    tiles = sorted({head["ta"], head["tb"]})
    mine = [i for t in tiles for i in range(t * TILE, min(len(names), (t + 1) * TILE))]
    place = np.full(len(names), -1)
    place[mine] = np.arange(len(mine))
    n_terms = rows.num_rows
    counts = np.zeros((len(mine), 1 << max(0, n_terms - 1).bit_length()), np.int64)
    counts[:, n_terms:] = -1
    if n_terms:
        by = rows["by"].chunk(0) if isinstance(rows["by"], pa.ChunkedArray) else rows["by"]
        entries = by.flatten()
        source = place[pc.index_in(entries.field("source"), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False)]
        term = np.repeat(np.arange(n_terms), by.value_lengths().to_numpy(zero_copy_only=False))
        counts[source[source >= 0], term[source >= 0]] = entries.field("n").to_numpy(zero_copy_only=False)[source >= 0]
    sizes = [sizes[i] for i in mine]
    i, j = np.triu_indices(len(mine), 1)
    if len(tiles) == 2:
        across = (i < TILE) & (j >= TILE)
        i, j = i[across], j[across]
    out = {c: [] for c in ("source", "part", "item", "value")}

    def put(source: list, part: str, item: list, value: np.ndarray) -> None:
        out["source"] += source
        out["part"] += [part] * len(source)
        out["item"] += item
        out["value"] += value.tolist()

    if len(i):
        there, back = price_pairs(counts, [max(1, s) for s in sizes], i, j)
        a, b = [names[mine[x]] for x in i], [names[mine[x]] for x in j]
        put(a, "pair", b, there)
        put(b, "pair", a, back)
    if len(tiles) == 1 and n_terms:
        q = shares(rows["total"].to_numpy(), head["n"] + head["v"])
        terms = rows["term"].to_pylist()
        for k, size in enumerate(sizes):
            c = counts[k, :n_terms]
            p = shares(c, size)
            at = np.flatnonzero((c > 0) & (p > q))
            value = (p[at] - q[at]) ** 2 // q[at]
            if len(at) > most:
                dear = value >= np.partition(value, len(at) - most)[len(at) - most]
                at, value = at[dear], value[dear]
            put([names[mine[k]]] * len(at), "term", [terms[x].decode("utf-8", "replace") for x in at], value)
    n = len(out["value"])
    columns = [pa.array([head["lang"]] * n, pa.string()), *(pa.array(out[c], pa.string()) for c in ("source", "part", "item")), pa.array(out["value"], pa.int64())]
    return pa.Table.from_arrays(columns, names=["lang", "source", "part", "item", "value"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3) -> DataFrame:
    """(lang, term, total, docs, by) of each kept term; ``by`` lists the occurrences by source. Each lang's empty term lists all its sources.

    Tasks pass on sums of bounded many (source, term); a term's rows meet by a hash of lang and term.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    raw = docs.select(texts[0].alias("lang"), texts[1].alias("source"), texts[2].cast("binary").alias("text")).mapInArrow(tidy(count_terms), COUNTS)
    counts = raw.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
    return terms.where((F.col("docs") >= least_docs) | (F.length("term") == 0))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source apart from the other sources of its lang, in exact integers.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case; a lang keeps the V terms of at least ``least_docs``
    of its documents. A term's share in a source is p = 1 + floor(10^9 (count + 1) / (N + V)), N the source's occurrences of kept terms. Part ``pair``
    has each other source of the lang with the sum over all kept terms of floor((p - q)^2 / q), q its share. Part ``term``
    has the kept terms that the source holds more of than the lang as a whole (p > q), ranks up to ``most_terms``. Equal values rank by item.

    A lang's terms are dealt by hash into blocks that hold at most some 65,536 counts, ordered inside by falling frequency so that rare
    terms, whose subtrees are alike, lie together; with more than 256 sources a block is one task for each pair of tiles of sources.
    The sources of a lang are listed in one row; nothing else is gathered.

    Null text, lang and source are ''. Documents are rows, also those that repeat. A source without terms has pairs; with V = 0 their
    value is 0. A lang of one source has no pair. An empty table gives an empty result. Extra columns are ignored.
    """
    terms = materialize(term_counts(docs, text_col, lang_col, source_col, least_docs), "terms")
    sizes = terms.select("lang", F.explode("by").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("size"))
    lists = sizes.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "size"))).alias("groups"))
    totals = terms.groupBy("lang").agg(F.count_if(F.length("term") > 0).alias("v"), F.sum("total").alias("n"))
    n_sources = F.size("groups")
    width = F.greatest(F.lit(1), F.floor(F.lit(BLOCK) / n_sources))
    tiles = F.ceil(n_sources / TILE).cast("int")
    heads = totals.join(lists, "lang").withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("v") / width)).cast("int"), "tiles": tiles})
    heads = materialize(heads, "heads")

    def dealt(df: DataFrame) -> DataFrame:
        """A row for each pair of tiles: one, with up to 256 sources."""
        split = df.withColumn("ta", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return split.withColumn("tb", F.explode(F.sequence("ta", F.col("tiles") - 1)))

    of_terms = terms.where(F.length("term") > 0).join(heads.select("lang", "blocks", "tiles"), "lang")
    of_terms = of_terms.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    of_heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    none = F.lit(None)
    rows = dealt(of_terms).select("lang", "block", "ta", "tb", "term", "total", "by", none.cast("long").alias("v"), none.cast("long").alias("n"), none.cast(heads.schema["groups"].dataType).alias("groups"))
    every = rows.unionByName(dealt(of_heads).select("lang", "block", "ta", "tb", "v", "n", "groups"), allowMissingColumns=True)
    prices = materialize(every.groupBy("lang", "block", "ta", "tb").applyInArrow(lambda t: price_block(t, most_terms), PRICES), "prices")

    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = prices.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(w))
    best = prices.where("part = 'term'").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most_terms)
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


ORACLE = r"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
    c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    v AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
    s AS (SELECT g.lang, g.source, v.v, v.v + coalesce(sum(c.n), 0) AS size FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source, v.v),
    p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // size AS p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (v.v + v.n) AS q
        FROM s JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""
