"""Best-fit packing planned on the histogram of lengths; documents then take planned places by rank within their length."""

from __future__ import annotations

import bisect
import struct
import unicodedata
import zlib
from array import array
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.common import distributed_rank, materialize

#: Code points of texts that are split here: Latin, Greek, Cyrillic, Hebrew, Arabic, punctuation, currency, arrows and common signs, CJK
#: signs, kana, ideographs, Hangul, full-width forms. Tests compare each of them with the library.
PLAIN = ((0x0000, 0x02FF), (0x0370, 0x0482), (0x048A, 0x052F), (0x05D0, 0x05EA), (0x0621, 0x064A), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x218B), (0x2190, 0x23FF), (0x2500, 0x27BF), (0x3000, 0x3029), (0x3041, 0x3096), (0x309D, 0x30FF), (0x3400, 0x4DB5), (0x4E00, 0x9FD5), (0xAC00, 0xD7A3), (0xFF01, 0xFFEE))
#: Special tokens and contractions of the tokenizer file word_bpe_49k.json, and Unicode's white space (fixed values).
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
END_ID = 1
CACHED_CHUNKS = 300_000


def _ranges(prefix: str) -> str:
    """The characters of a Unicode category in the basic plane as the inside of a character class."""
    out, start = [], None
    for c in range(0x10001):
        inside = c < 0x10000 and unicodedata.category(chr(c)).startswith(prefix)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


class WordTokenizer:
    """Ids of texts under a word-level BPE file, as little-endian unsigned 32-bit bytes; equal to the tokenizers library's.

    No token spans white space, and chunks between white space repeat, so each worker keeps the ids of the chunks it has met and only
    new chunks are split and go through BPE. Texts that, in normal form C, hold special tokens, a capital sigma (whose lower case
    depends on its place in Python), separators that only Python takes for white space, or any character outside ``PLAIN`` go to the
    library whole.
    """

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        letters, numbers = _ranges("L"), _ranges("N")
        self.find = re.compile(f"[{letters}]+|{CONTRACTIONS}|[{numbers}]|[^{SPACES}{letters}{numbers}]+").findall
        plain = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in PLAIN)
        self.odd = re.compile(f"[\\x1c-\\x1fΣ]|[^{plain}]").search
        # Byte-level alphabet: printable Latin-1 stands for itself, other bytes for characters from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {}
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            if token in SPECIAL:
                continue
            body, end = (token[:-4], b"\xff") if token.endswith("</w>") else (token, b"")
            ranks[bytes(byte[c] for c in body) + end] = i
        self.bpe = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        if len(self.known) > CACHED_CHUNKS:
            self.known.clear()
        known, bpe, find = self.known, self.bpe, self.find
        for c in chunks:
            if c not in known:
                ids = array("I")
                for w in find(c.lower()):
                    ids.extend(bpe(w.encode() + b"\xff"))  # 0xff, which is in no text's UTF-8, ends a word
                known[c] = ids.tobytes()

    def ids(self, text: str) -> bytes:
        normal = text if text.isascii() else unicodedata.normalize("NFC", text)
        if self.odd(normal) or "<|" in text and any(s in text for s in SPECIAL):
            found = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(found)}I", *found)
        chunks = normal.split()
        try:
            return b"".join(map(self.known.__getitem__, chunks))
        except KeyError:
            self._learn(chunks)
            return b"".join(map(self.known.__getitem__, chunks))


@cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", place_col: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32, place and, if asked for, ids.

    A document's ids are its text's (null: empty), then the end id. Only longer documents are cut, into pieces of ``capacity``.
    place is the value of ``place_col`` (long), or 0.
    """
    fields = [*PIECES, T.StructField("place", T.LongType())]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType())] if with_ids else fields)
    end = struct.pack("<I", END_ID)

    def cut(batches):
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            out = [[] for _ in schema]
            for i, text, place in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids = tok.ids(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for col, v in zip(out, (i, k, at // 4, len(part) // 4, zlib.crc32(part), place, part), strict=False):
                        col.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=False)], names=schema.names)

    place = F.col(place_col).cast("long") if place_col else F.lit(0).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), place.alias("place")).mapInArrow(cut, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows: length, first rank, count, first sequence, first copy, offset, copies per sequence.

    Sequences that hold the same lengths form one group with a count. A length goes first to the group with the least room that it
    fits, where each sequence takes as many as it can hold, then to the next, then to new sequences. Each length splits at most one
    group, so groups, and the plan, stay within a small multiple of the number of distinct lengths, which is at most ``capacity``.
    """
    rows, groups, next_seq = [], [], 0  # groups: sorted (room, first sequence, number of sequences)
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(groups, (length,))
            if at < len(groups):
                room, seq, n = groups.pop(at)
            else:
                room, seq, n = capacity, next_seq, -(-left // (capacity // length))
                next_seq += n
            per = room // length
            full = min(n, left // per)
            partial = min(left - full * per, per) if full < n else 0
            for start, bins, copies in ((seq, full, per), (seq + full, 1 if partial else 0, partial)):
                if bins:
                    rows.append((length, rank, bins * copies, start, capacity - room, copies))
                    rank += bins * copies
                    left -= bins * copies
                    bisect.insort(groups, (room - copies * length, start, bins))
            if rest := n - full - bool(partial):
                bisect.insort(groups, (room, seq + full + bool(partial), rest))
    return rows


def best_fit_pack(pieces: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece"), ranges: str | None = None) -> DataFrame:
    """Give each row of ``pieces`` (column length, 1 to ``capacity``) a sequence_id and an offset.

    Only the histogram (at most ``capacity`` rows) reaches the driver. The plan is joined to the pieces on their length, and a piece's
    rank within its length picks its place. Ranks are found by :func:`distributed_rank`, so one very frequent length is many tasks.
    With ``ranges`` (a column of non-negative longs, the first of ``order``) ranks follow that column; else the order of a hash.
    ``pieces`` should be a written table: it is read several times. No rows give no rows; rows that repeat each get a place.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    segments = spark.createDataFrame(plan(histogram, capacity), "length_ long, first_ long, n_ long, seq_ long, at_ long, per_ long")
    segments = segments.groupBy("length_").agg(F.sort_array(F.collect_list(F.struct("first_", "n_", "seq_", "at_", "per_"))).alias("plan_"))
    ranked = distributed_rank(pieces, "length", list(order), "rank_", ranges=ranges).join(F.broadcast(segments), F.col("length") == F.col("length_"))
    mine = F.element_at(F.filter("plan_", lambda s: (s["first_"] <= F.col("rank_")) & (F.col("rank_") < s["first_"] + s["n_"])), 1)
    k = F.col("rank_") - F.col("s_.first_")
    return ranked.withColumn("s_", mine).select(
        *[F.col(c) for c in pieces.columns],
        (F.col("s_.seq_") + F.floor(k / F.col("s_.per_"))).cast("long").alias("sequence_id"),
        (F.col("s_.at_") + (k % F.col("s_.per_")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", place_col: str | None = None) -> DataFrame:
    """Tokenize, cut and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of one length take their places in the buckets' order of ``place_col`` if that is given, else of a hash of id, piece and
    digest, so pieces without an id are spread too; pieces that agree in all of it take theirs in any order. Null and empty texts are one piece with the end id alone. Rows that repeat each are documents of their own; an id may be null. An empty table
    gives an empty result. Extra columns are ignored.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, id_col, text_col, place_col), "pieces")
    return best_fit_pack(pieces, capacity, ("place", "doc_id", "piece", "ids_crc32"), ranges="place" if place_col else None).drop("place")
