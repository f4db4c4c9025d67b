"""Source divergence, the compression classifier and vector codes against brute force, with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from offerloom.llm import divergence, pii, quality, toxicity, url_filter, vector_codes
from offerloom.llm.queries import table

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.1")


def plain_divergence(rows, least=3, most=200):
    """(lang, source, part, item): (value, rank), straight from the definition, in Python integers."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", [t.translate(low) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for text, lang, source in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        seen, count = Counter(), {}
        for x, source, terms in docs:
            if x == lang:
                seen.update(set(terms))
                count.setdefault(source, Counter()).update(terms)
        kept = sorted(t for t, n in seen.items() if n >= least)
        count = {s: {t: c[t] for t in kept} for s, c in count.items()}
        whole = {t: sum(c[t] for c in count.values()) for t in kept}
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))  # noqa: B023, E731
        for s, c in count.items():
            pairs = [(o, sum((share(c, t) - share(count[o], t)) ** 2 // share(count[o], t) for t in kept)) for o in count if o != s]
            terms = [(t, (share(c, t) - share(whole, t)) ** 2 // share(whole, t)) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, top in (("pair", pairs, None), ("term", terms, most)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top], 1):
                    out[lang, s, part, item] = (value, rank)
    return out


def divergence_rows(rng, n):
    words = ["Alpha", "beta", "gamma", "épée", "ÉPÉE", "x1y", "naïve-co", "zz", *(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(60))]
    out = [(" ".join(rng.choices(words, weights=[9] * 8 + [1] * 60, k=rng.randrange(0, 40))), rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, f"t{rng.randrange(9)}"])) for _ in range(n)]
    return out + out[:20] + [(None, "en", "empty"), ("", None, None), ("123 !?", "xx", "one"), ("word word", "xx", "two"), ("a" * 5000, "en", "s1"), ("solo", "only", "s")]


@pytest.mark.parametrize("block, most", [(1 << 16, 200), (64, 5)])
def test_divergence(spark, monkeypatch, block, most):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = divergence_rows(random.Random(block), 300)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5).withColumns({"n": F.lit(1), "groups": F.lit("x"), "value": F.lit(2)})
    got = divergence.source_divergence(df, most_terms=most).collect()
    assert {(r.lang, r.source, r.part, r["item"]): (r.value, r["rank"]) for r in got} == (want := plain_divergence(rows, most=most)) and len(got) == len(want)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_divergence_counts_by_slices(spark, monkeypatch):
    """Texts cut into slices and held counts passed on early sum up to the same."""
    rows = divergence_rows(random.Random(4), 200)
    arrays = [pa.array([r[i] or "" for r in rows]) for i in (1, 2)] + [pa.array([(r[0] or "").encode() for r in rows], pa.binary())]
    batch = pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "text"])
    sums = lambda: {(r["lang"], r["source"], r["term"]): 0 for b in divergence.count_terms([batch]) for r in b.to_pylist()}

    def total():
        out = Counter()
        for b in divergence.count_terms([batch.slice(0, 90), batch.slice(90)]):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return out

    want = total()
    monkeypatch.setattr(divergence, "SLICE", 100)
    monkeypatch.setattr(divergence, "HELD", 50)
    assert total() == want and sum(v for k, v in want.items() if k[2:] == (b"", "docs")) == len(rows) and sums()


def test_divergence_tiles_and_shared_nodes(monkeypatch):
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (9, 32))
    counts[:, 20:] = -1
    counts[3] = counts[4]
    sizes = [int(c[c > 0].sum()) + 20 for c in counts]
    i, j = np.triu_indices(9, 1)
    leaves, levels, roots = divergence.consed_trees(counts)
    assert roots[3] == roots[4] and len(levels) == 5 and len(levels[0][0]) <= len(leaves) ** 2
    for frontier in (1 << 19, 64):
        monkeypatch.setattr(divergence, "FRONTIER", frontier)
        there, back = divergence.price_pairs(counts, sizes, i, j)
        for k, (a, b) in enumerate(zip(i, j, strict=True)):
            p, q = ([1 + 10**9 * (int(c) + 1) // sizes[x] for c in counts[x][:20]] for x in (a, b))
            assert there[k] == sum((x - y) ** 2 // y for x, y in zip(p, q, strict=True)) and back[k] == sum((x - y) ** 2 // x for x, y in zip(p, q, strict=True))
    by = [[{"source": f"s{g}", "n": int(counts[g, t])} for g in range(9) if counts[g, t] > 0] for t in range(20)]
    groups = [{"source": f"s{g}", "size": sizes[g] - 20} for g in range(9)]
    kind = pa.struct([("source", pa.string()), ("n", pa.int64())])
    head = pa.struct([("source", pa.string()), ("size", pa.int64())])

    def prices(tile):
        monkeypatch.setattr(divergence, "TILE", tile)
        out = Counter()
        tiles = -(-9 // tile)
        for ta in range(tiles):
            for tb in range(ta, tiles):
                t = pa.table({
                    "lang": ["x"] * 21, "ta": [ta] * 21, "tb": [tb] * 21, "term": pa.array([f"t{t}".encode() for t in range(20)] + [None], pa.binary()),
                    "total": pa.array([sum(e["n"] for e in x) for x in by] + [None], pa.int64()), "by": pa.array([*by, None], pa.list_(kind)),
                    "v": pa.array([None] * 20 + [20], pa.int64()), "n": pa.array([None] * 20 + [sum(sizes) - 180], pa.int64()), "groups": pa.array([None] * 20 + [groups], pa.list_(head)),
                })
                for r in divergence.price_block(t, 200).to_pylist():
                    out[r["source"], r["part"], r["item"], r["value"]] += 1
        return out

    assert prices(256) == prices(4) and max(prices(4).values()) == 1
    big = np.array([0, 10**10, 2**62])
    assert divergence.shares(big, 2**62 + 5).tolist() == [1 + 10**9 * (int(c) + 1) // (2**62 + 5) for c in big]


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error, label and the codebooks, in Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(1, *(len(v) for _, v, _ in kept)) // parts)
    cut = lambda v: [tuple((v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width]) for p in range(parts)]
    kept = [(i, cut(v), label) for i, v, label in kept]
    first = {}
    for i, v, _ in kept:
        first[i] = min(first.get(i, v), v)
    books = [[first[i][p] for i in sorted(first, key=lambda i: (i is None, i or 0))[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(near(v[p], books[p])[1], []).append(v[p])
            books[p] = [tuple(sum(x) // len(mine[e]) for x in zip(*mine[e], strict=True)) if e in mine else c for e, c in enumerate(books[p])]
    found = [(i, [near(v[p], books[p]) for p in range(parts)], label) for i, v, label in kept]
    total = Counter()
    for _, f, label in found:
        total[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[label], digest) for i, f, label in found)


@pytest.mark.parametrize("size, n", [(64, 300), (24, 40), (8, 200), (20, 60), (3, 9)])
def test_vector_codes(spark, size, n):
    rng = np.random.default_rng(size)
    v = rng.normal(size=(n, size)).round(1)  # many ties
    v[n // 2 :] = v[rng.integers(0, 3, n - n // 2)]
    rows = [(i, x, int(rng.integers(0, 4)) if i % 5 else None) for i, x in enumerate(v.tolist())]
    rows += [(900, None, 1), (901, [float("nan")] * size, 1), (902, [None] + [1.0] * (size - 1), 2), (903, [float("-inf")] + [0.0] * (size - 1), 2), (5, [0.5] * size, 3), (5, [0.5] * size, 3), (None, [0.25] * size, None), (7, [1.0], 1), (8, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4).withColumns({"q": F.lit(1), "n_": F.lit(2), "key_": F.lit(3)})
    got = vector_codes.compress_vectors(df).collect()
    assert Counter(tuple(r) for r in got) == plain_codes(rows)
    assert vector_codes.compress_vectors(df.limit(0)).count() == 0 == vector_codes.compress_vectors(df.where("vec_id between 900 and 903")).count()


def test_hadamard_elimination_is_exact():
    rng = np.random.default_rng(1)
    for width in (1, 3, 8, 13):
        parts, entries = rng.integers(-9, 9, (500, width)), rng.integers(-9, 9, (16, width))
        entries[9] = entries[2]
        d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        for first in (1, 2, 5):
            code, error = vector_codes.nearest(parts, entries, first)
            assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(None, entries=300)
    assert [int((np.diff(r) != 0).sum()) for r in vector_codes.hadamard(np.eye(8, dtype=np.int64)).T] == list(range(8))


def quality_rows(rng, n):
    good = lambda: " ".join("".join(rng.choices(["ta", "re", "no", "mi", "lo", "sun"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 200)))
    bad = lambda: rng.choice([" ".join(["spam!!"] * rng.randrange(5, 90)), "".join(rng.choices("#$%&*|", k=rng.randrange(20, 900)))])
    return [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(n)]


def test_quality(spark):
    rows = quality_rows(random.Random(6), 600)
    odd = [(1000, None), (1001, ""), (None, "ta re no mi"), (3, rows[3][1]), (1002, "lo " * 30000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string").withColumns({"x": F.lit(1), "score": F.lit("s"), "good": F.lit(0)})
    labels = spark.createDataFrame([(i, q) for i, _, q in rows[:500]] + [(3, 0), (2000, 1), (4, None)], "doc_id long, quality int").withColumn("text", F.lit("t"))
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) if r.doc_id is not None else r.held_out is None for r in got)
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score and by_id[1001].own_size == 0
    assert quality.score_quality(docs.limit(0), labels).count() == 0

    model = quality.fit_quality(docs, labels)
    sizes = lambda blob, d: len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_dict_id=False).compress(blob))
    for i in (1, 3, 1002):
        text = (by_id[i] and next(t for k, t in [*odd, *((a, b) for a, b, _ in rows)] if k == i)).encode()
        blocks = [text[k : k + 1024] for k in range(0, len(text), 1024)]
        g, b = ([sizes(x, d) for x in blocks] for d in (model.good, model.bad))
        want = [(sum(b) - sum(g)) / (sum(b) + sum(g)), sum(g) / len(text), min((y - x) / (y + x) for x, y in zip(g, b, strict=True)), sizes(text, None) / len(text)]
        assert [by_id[i][c] for c in quality.FEATURES] == pytest.approx(want)
        z = sum(w * t for w, t in zip(model.weights, [*want[:3], min(want[1], model.hinges[0]), min(want[3], model.hinges[1])], strict=False)) + model.weights[-1]
        assert by_id[i].score == pytest.approx(1 / (1 + math.exp(-z)))


def test_quality_with_too_few_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "doc_id long, text string")
    for labels, share in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(2, 0)], 0.0), ([(0, 1), (1, 0)], None)):
        got = quality.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(got) == 10 and len({r.score for r in got}) == 1 and (share is None or got[0].score == share)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_quality_and_toxicity(spark):
    """Accuracy on the labelled rows that are held out."""
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    q = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (q.predicted[q.quality == 1] == 1).mean() > 0.99 and (q.predicted[q.quality == 0] == 0).mean() > 0.93
    t = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (t.predicted[t.toxic == 1] == 1).mean() > 0.9 and (t.predicted[t.toxic == 0] == 0).mean() > 0.99


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_urls(spark):
    """The trees' side of URLs that a rule labels, for those kept out of the training."""
    pages = table(spark, DATA, "pages")
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    got = url_filter.filter_urls(pages, held_out=held).join(pages.select("page_id", "url"), "page_id").where(held & F.col("rule").isNotNull()).toPandas()
    assert len(got) > 150 and ((got.score >= 0.5) == (got.verdict == "block")).mean() > 0.95


def test_pii_of_some_hundred_planted_identifiers(spark):
    """Spelt-out addresses and grouped numbers beside words that fixed patterns teach, among numbers that are none."""
    rng = random.Random(11)
    name = lambda: "".join(rng.choices("abcdefghij", k=7))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    texts, planted = [], {}
    for i in range(400):
        email, phone = f"{name()}@{name()}.org", f"+49 {digits(3)} {digits(7)}"
        texts.append(f"please write mail to {email} soon . {name()} {name()} call my phone {phone} today")
    for i in range(300):
        email, phone = f"{name()} (at) {name()} (dot) org", f"{digits(4)} {digits(3)} {digits(4)}"
        start = "please write mail to "
        text = f"{start}{email} soon . {name()} call my phone {phone} today . room {digits(5)} of {digits(6)} items"
        planted[len(texts)] = {f"email:{len(start)}:{len(start) + len(email)}", f"phone:{text.index(phone)}:{text.index(phone) + len(phone)}"}
        texts.append(text)
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = {i: set(r.spans.split(",")) - {""} for i, r in got.items() if r.n_added}
    right = sum(len(found.get(i, set()) & want) for i, want in planted.items())
    assert right >= 0.9 * 600 and right >= 0.95 * sum(r.n_added for r in got.values()), (right, sum(r.n_added for r in got.values()))


def test_toxicity_features_against_plain_distances():
    lexicon = [("stupid", 3.0), ("moron", 2.0), ("worthlessness", 4.0), ("scum", 1.0)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def nearest(word):
        hits = [(distance(word, t), k) for k, (t, _) in enumerate(lexicon)]
        hits = [(d, k) for d, k in hits if d <= toxicity.allowed_edits(lexicon[k][0])]
        return min(hits) if word and hits else None

    def plain(text):
        tokens = text.split()
        found = []
        for i, t in enumerate(tokens):
            w = toxicity.clean(t)
            hit = nearest(w) or nearest(w.translate(toxicity.LOOKS_LIKE))
            if hit:
                lo, hi = max(0, i - toxicity.WINDOW), i + toxicity.WINDOW + 1
                words = {toxicity.clean(x) for x in tokens[lo:hi]}
                opens = any(x[0] in toxicity.QUOTES for x in tokens[lo : lo + toxicity.WINDOW + 1])
                closes = any(x.rstrip(".,;:!?")[-1:] in toxicity.QUOTES for x in tokens[lo:hi][min(i, toxicity.WINDOW) :] if x.rstrip(".,;:!?"))
                quoted = (opens and closes) or bool(words & toxicity.REPORT)
                found.append((hit, quoted, bool(words & toxicity.ADDRESS)))
        if not found:
            return [0.0] * 7
        n = len(found)
        return [
            math.log1p(n), sum(lexicon[k][1] / (1 + d) for (d, k), _, _ in found) / n, math.log1p(sum(d > 0 for (d, _), _, _ in found)), math.log1p(sum(q for _, q, _ in found)),
            math.log1p(sum(a and not q for _, q, a in found)), min(1.0, 20 * n / len(tokens)), math.log1p(len({k for (_, k), _, _ in found})),
        ]

    rng = random.Random(9)
    pool = ["you", "said", "the", "'stupid'", '"moron', 'scum".', "stup1d", "STUPID!", "stupd", "morons", "worthlesness", "worthlesnes", "sccum", "of", "wörthless", "you,", "a", "...", "moon"]
    scorer = toxicity.Scorer(lexicon)
    for text in ["", "  ", *(" ".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(400))]:
        assert scorer.features(text) == pytest.approx(plain(text)), text
