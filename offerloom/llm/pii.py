"""Personal data: fixed patterns find the seeds, and the contexts of seeds find identifiers of other forms.

Seeds (spans of the fixed patterns) induce lexical patterns: the words beside them. Patterns and the instances they extract form a
graph. A pattern's score for a kind is the smoothed mean of its instances' scores, an instance's score the best of its patterns';
both are recomputed in turns. Instances whose score is high become spans and, from the next turn on, count like seeds, so the other
words beside them become patterns too. Turns end when nothing changes.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import discard, materialize

KINDS = ("email", "ip", "card", "phone")
SLICE = 500
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The whole run of digits is taken even where no address follows: no later start in the run could match either.
_IP = re.compile(r"[0-9]+(?:(\.[0-9]+)(\.[0-9]+)(\.[0-9]+))?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
# Forms of identifiers that the fixed patterns don't take: addresses that are spelt out, runs of groups of digits, single tokens.
_SPELT = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:[(\[{] ?at ?[)\]}]| at |@) ?[A-Za-z0-9-]+(?: ?(?:[(\[{] ?dot ?[)\]}]| dot |\.) ?[A-Za-z0-9-]+)+", re.I)
_GROUPS = re.compile(r"[+(]{0,2}[0-9]+(?:[ ()./-]{1,2}[0-9]+)+")
_EDGES = ".,;:!?()[]{}<>\"'`*&$%#=|"


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted; kind indexes KINDS."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if m[1] and all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _context(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: one to three words before, one or two after, one on each side; all within 60 characters and a line."""
    norm = lambda w: w.lower().strip(_EDGES)
    left = [norm(w) for w in text[max(0, start - 60) : start].rsplit("\n", 1)[-1].split()[-3:]]
    right = [norm(w) for w in text[end : end + 60].split("\n", 1)[0].split()[:2]]
    out = [f"L {' '.join(left[-k:])}" for k in range(1, len(left) + 1) if all(left[-k:])]
    out += [f"R {' '.join(right[:k])}" for k in range(1, len(right) + 1) if all(right[:k])]
    if left and right and left[-1] and right[0]:
        out.append(f"M {left[-1]} _ {right[0]}")
    return out


def _may_be(text: str) -> int:
    """The kinds (as bits) that a text of this form may be: an address has a sign for "at", the others have so many digits."""
    n, groups = sum(c.isdigit() for c in text), len(re.findall("[0-9]+", text))
    at = "@" in text or re.search(r"[^a-z]at[^a-z]", text, re.I) is not None
    letters = any(c.isalpha() for c in text)
    return at << 0 | (groups == 4 and n <= 12 and not letters) << 1 | (12 <= n <= 19 and not letters) << 2 | (6 <= n <= 15 and not letters) << 3


def _others(text: str, spans: list[tuple[int, int, int]]):
    """(start, end, possible kinds) of identifier-like places outside the spans: the longest form at each, no marks at its edges."""
    found = []
    if " dot " in text or "@" in text or re.search(r"[(\[{] ?at ?[)\]}]", text, re.I):
        found += [m.span() for m in _SPELT.finditer(text)]
    if _DIGIT.search(text):
        found += [m.span() for m in _GROUPS.finditer(text)]
        last = -1
        for d in re.finditer("[0-9@]", text):
            if d.start() >= last:
                a = d.start()
                while a > 0 and not text[a - 1].isspace():
                    a -= 1
                a, last = _TOKEN.match(text, a).span()
                b = last
                while a < b and text[a] in _EDGES:
                    a += 1
                while b > a and text[b - 1] in _EDGES:
                    b -= 1
                found.append((a, b))
    taken = [(a, b) for a, _, b in spans]
    for a, b in sorted(found, key=lambda x: x[0] - x[1]):
        if b - a >= 5 and (may := _may_be(text[a:b])):
            taken_at = bisect.bisect_left(taken, (a, b))
            if not any(x < b and a < y for x, y in taken[max(0, taken_at - 1) : taken_at + 1]):
                taken.insert(taken_at, (a, b))
                yield a, b, may


OCCURRENCES = "array<struct<kind:int,may:int,start:long,end:long,inst:string,patterns:array<string>>>"


def _find(batches):
    kind_t = pa.list_(pa.struct([("kind", pa.int32()), ("may", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("inst", pa.string()), ("patterns", pa.list_(pa.string()))]))
    for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):  # few texts and spans are objects at a time
        ids, keys, counts, shas, found = [], [], ([], [], [], []), [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            spans = base_spans(text)
            ids.append(i)
            keys.append(xxhash.xxh64_intdigest(text.encode()) - (1 << 63))
            for k, c in enumerate(counts):
                c.append(sum(s[1] == k for s in spans))
            listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
            shas.append(hashlib.sha256(listed.encode()).hexdigest())
            rows = [{"kind": k, "may": 1 << k, "start": a, "end": b, "inst": text[a:b].lower(), "patterns": _context(text, a, b)} for a, k, b in spans]
            rows += [{"kind": None, "may": may, "start": a, "end": b, "inst": text[a:b].lower(), "patterns": _context(text, a, b)} for a, b, may in _others(text, spans)]
            found.append(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas), pa.array(found, kind_t)],
            names=["doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "found"],
        )


def bootstrap(occurrences: DataFrame, most_rounds: int | None = None, least_seeds: int = 3, least_pattern: float = 0.5, accept: float = 0.8, smoothing: float = 1.0) -> DataFrame:
    """(inst, kind, score): unseen instances whose score reaches ``accept``.

    ``occurrences`` has kind (null: not a seed), may (possible kinds as bits), inst and patterns. Each distinct (pattern, instance) is
    one edge of the graph. A pattern's score for a kind is the sum of its instances' scores over their number plus ``smoothing``. Seeds
    count 1, and so do accepted instances; others count their score in whole thousandths. Patterns take part if they reach
    ``least_pattern`` and have ``least_seeds`` seeds or accepted instances. No score ever falls from one round to the next, so rounds go on until
    the sum of all is what it was, which means that nothing changes any more; with ``most_rounds`` they may end before.
    """
    edges = occurrences.select("kind", "may", "inst", F.explode("patterns").alias("pattern")).groupBy("pattern", "inst").agg(F.min("kind").alias("kind"), F.max("may").alias("may"))
    edges = materialize(edges, "graph")
    open_edges = edges.where("kind is null").select("pattern", "inst", "may")
    seeds = edges.where("kind is not null").groupBy("pattern", "kind").agg((F.count(F.lit(1)) * 1000).alias("s"), F.count(F.lit(1)).alias("sure"))
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scores, before, rounds = None, None, 0
    while most_rounds is None or rounds < max(1, most_rounds):
        mass, rounds = seeds, rounds + 1
        if scores is not None:
            more = open_edges.join(scores, "inst").groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.count_if(F.col("score") == 1000).alias("sure"))
            mass = mass.unionByName(more).groupBy("pattern", "kind").agg(F.sum("s").alias("s"), F.sum("sure").alias("sure"))
        strong = mass.where(F.col("sure") >= least_seeds).join(size, "pattern").withColumn("p", F.col("s") / 1000 / (F.col("n") + smoothing)).where(F.col("p") >= least_pattern).select("pattern", "kind", "p")
        reached = open_edges.join(strong, "pattern").where(F.expr("(may >> kind) & 1 = 1")).groupBy("inst", "kind").agg(F.max("p").alias("p"))
        thousandths = F.when(F.col("p") >= accept, 1000).otherwise(F.floor(F.col("p") * 1000)).cast("long")
        last, scores = scores, materialize(reached.select("inst", "kind", "p", thousandths.alias("score")), "scores")
        if last is not None:
            discard(last)
        now = scores.agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s")).first()
        if now == before or not now.n:
            break
        before = now
    best = scores.where("score = 1000").groupBy("inst").agg(F.max(F.struct("p", -F.col("kind"))).alias("b"))
    return best.select("inst", (-F.col("b")["col2"]).cast("int").alias("kind"), F.col("b.p").alias("score"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rounds: int | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row of ``docs``.

    The counts and base_sha256 are of the fixed patterns; spans lists these and the spans that bootstrapping adds, as kind:start:end
    by start and kind, with ends exclusive, in code points. Bootstrapping adds what stands beside other identifiers of its kind and has
    a form that fits: spelt-out addresses, groups of digits, tokens with a digit or @; its rounds go on until nothing changes. A null text counts as empty. Rows that repeat each get a row; a null id
    stays null. An empty table gives an empty result. Extra columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(texts.mapInArrow(_find, f"doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, found {OCCURRENCES}"), "pii")
    each = rows.select("doc_id", "text_key", F.explode("found").alias("o")).select("doc_id", "text_key", "o.*")
    known = bootstrap(each, most_rounds)
    added = each.where("kind is null").drop("kind").join(known, "inst").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    base = F.transform(F.filter("found", lambda o: o["kind"].isNotNull()), lambda o: F.struct(o["start"].alias("start"), o["kind"].alias("kind"), o["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = rows.join(added.withColumnsRenamed({"doc_id": "d", "text_key": "t"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(F.array_sort(F.concat(base, F.coalesce("more", none))), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(spans, ",").alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_added"))
