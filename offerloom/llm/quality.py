"""Quality classifier by compression: how much better the dictionary of good texts compresses a text than that of bad ones."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import discard, materialize, release_memory, strata, tidy
from offerloom.llm.toxicity import fit_logistic, held_out

#: Bytes of a block: each is compressed afresh, so the dictionary counts from the first to the last part of a text.
BLOCK = 1024
#: Bytes of a dictionary, and zstandard's level.
DICTIONARY, LEVEL = 112 << 10, 3
FEATURES = ("difference", "size", "least_difference", "own_size")


def blocks_of(text: bytes) -> list[bytes]:
    return [text[k : k + BLOCK] for k in range(0, len(text), BLOCK)]


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary of the blocks; the end of the blocks themselves where there are too few to train one."""
    size = min(DICTIONARY, sum(map(len, blocks)) // 8)
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICTIONARY:]


class Sizes:
    """Compressed sizes of texts with the dictionaries of good and of bad texts, and without one."""

    def __init__(self, good: bytes, bad: bytes):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        dictionaries = [zstandard.ZstdCompressionDict(d) for d in (good, bad)]
        for d in dictionaries:
            d.precompute_compress(level=LEVEL)
        self.good, self.bad = (zstandard.ZstdCompressor(dict_data=d, **options) for d in dictionaries)
        self.plain = zstandard.ZstdCompressor(**options)

    def features(self, text: bytes) -> list[float]:
        """FEATURES of a text: the normalised difference of both sizes, summed over its blocks; the size with the good dictionary by
        the length; the lowest difference of a block; the size of the whole text by itself by the length. Zeros for the empty text."""
        if not text:
            return [0.0] * len(FEATURES)
        blocks = blocks_of(text)
        good, bad = [len(self.good.compress(b)) for b in blocks], [len(self.bad.compress(b)) for b in blocks]
        g, b = sum(good), sum(bad)
        return [(b - g) / (b + g), g / len(text), min((y - x) / (y + x) for x, y in zip(good, bad, strict=True)), len(self.plain.compress(text)) / len(text)]


def feature_udf(good: bytes, bad: bytes):
    """A column function: the features of a binary text."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = Sizes(good, bad)
        for texts in batches:
            yield pd.Series([sizes.features(t or b"") for t in texts], dtype=object)
        del sizes
        release_memory()

    return features


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, the bounds of the sizes' second terms, and the weights; without weights the share of good labels is every score."""

    good: bytes = b""
    bad: bytes = b""
    hinges: tuple[float, float] = (0.0, 0.0)
    weights: tuple[float, ...] | None = None
    share: float = 0.5

    def features(self, text: Column) -> Column:
        if self.weights is None:
            return F.array(*[F.lit(0.0)] * len(FEATURES))
        return feature_udf(self.good, self.bad)(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))

    def score(self, x: Column) -> Column:
        if self.weights is None:
            return F.lit(self.share)
        terms = [x[0], x[1], x[2], F.least(x[1], F.lit(self.hinges[0])), F.least(x[3], F.lit(self.hinges[1]))]
        z = F.lit(self.weights[-1])
        for t, w in zip(terms, self.weights[:-1], strict=True):
            z = z + t * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, good: bytes, bad: bytes) -> QualityModel:
    """Logistic weights of the features. Sizes count once more up to their 5 % quantile among good texts: below it a text repeats itself."""
    hinges = tuple(float(np.quantile(x[y == 1, k], 0.05)) for k in (1, 3))
    terms = np.column_stack([x[:, :3], np.minimum(x[:, 1], hinges[0]), np.minimum(x[:, 3], hinges[1])])
    mean, spread = terms.mean(axis=0), terms.std(axis=0) + 1e-9
    w = fit_logistic((terms - mean) / spread, y, l2=0.01, c=weight)
    scaled = w[:-1] / spread
    return QualityModel(good, bad, hinges, (*map(float, scaled), float(w[-1] - scaled @ mean)))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``most`` labelled rows that are not held out (text, good, weight), and the number of labels of each kind.

    Half of each kind at most, as far as there are so many, in order of a hash of their ids; weight is what a row stands for.
    """
    good = (F.col(label_col) == 1).cast("int")
    marked = labels.where(F.col(label_col).isNotNull() & F.coalesce(~held_out(id_col), F.lit(False))).select(F.col(id_col).alias("label_id"), good.alias("good"))
    n = {r.good: r.n for r in marked.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    k = strata(n.get(0, 0), n.get(1, 0), most)
    of = [marked.where(F.col("good") == t).orderBy(F.xxhash64("label_id"), "label_id").limit(k[t]).withColumn("weight", F.lit(n.get(t, 0) / max(1, k[t]))) for t in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(of[0].unionByName(of[1])), F.col("id_") == F.col("label_id"))  # ``most`` rows of three numbers
    rows = materialize(rows.select("text", "good", "weight", F.xxhash64("text").alias("order_")), "labelled")
    return rows.orderBy("order_").limit(most), n  # documents may repeat a labelled id


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_train: int = 20_000, most_blocks: int = 4096) -> QualityModel:
    """Dictionaries from one half of at most ``most_train`` labelled rows, by a hash of their texts, and the calibration from the other.

    Each dictionary is trained on at most ``most_blocks`` blocks of 1,024 bytes, which come to the driver; of the calibration only numbers do.
    """
    sample, n = labelled_sample(docs, labels, id_col, text_col, label_col, most_train)
    if not (n.get(0) and n.get(1)):
        return QualityModel(share=n.get(1, 0) / sum(n.values()) if n else 0.5)
    rows = materialize(sample, "sample")
    side = F.pmod("order_", F.lit(2))

    def cut(batches):
        for batch in batches:
            for text, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks = blocks_of(text)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary()), pa.array([good] * len(blocks), pa.int32())], names=["block", "good"])

    blocks = rows.where(side == 0).select("text", "good").mapInArrow(tidy(cut), "block binary, good int")
    good, bad = ([bytes(r.block) for r in blocks.where(F.col("good") == t).orderBy(F.xxhash64("block"), "block").limit(most_blocks).collect()] for t in (1, 0))
    good, bad = train_dictionary(good), train_dictionary(bad)
    known = rows.where(side == 1).select(feature_udf(good, bad)("text").alias("x"), "good", "weight", "order_").orderBy("order_").collect()
    discard(rows)
    x, y, weight = (np.array([r[k] for r in known], float) for k in ("x", "good", "weight"))
    if not good or not bad or not len(y) or y.min() == y.max():  # too few labels for both halves
        return QualityModel(share=n[1] / (n[0] + n[1]))
    return calibrate(x, y, weight, good, bad)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least: float = 0.3, most_train: int = 20_000, most_blocks: int = 4096) -> DataFrame:
    """(doc_id, held_out, score, predicted, and FEATURES) for every row of ``docs``; predicted is 1 for scores of ``least`` and more.

    Learns only from rows of ``labels`` (doc_id, quality) with crc32(doc_id as text) mod 5 other than 0, from at most ``most_train`` of them,
    drawn by kind, and ``most_blocks`` blocks for a dictionary; nothing but the text enters a score. Every byte of every text is
    compressed, in blocks; no row moves once the model is learned.

    Null texts count as empty; empty texts have features of 0 and the score that goes with them. With labels of one kind, none, or too
    few for both halves, every score is the share of good labels (0.5 without labels) and the features are 0. A null id has held_out null;
    repeated rows each get a row. An empty table gives an empty result. Extra columns are ignored.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col, most_train, most_blocks)
    rows = docs.select(F.col(id_col).alias("doc_id"), model.features(F.col(text_col)).alias("x"))
    score = model.score(F.col("x"))
    out = rows.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"), "x")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"), *[F.col("x")[k].alias(c) for k, c in enumerate(FEATURES)])
