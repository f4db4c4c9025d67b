"""Toxicity scores: a learned lexicon, matched with spelling errors by Levenshtein automata over a trie, and context windows.

The lexicon is learned from labelled rows: words whose share among toxic documents stands out. A trie of these words is intersected
with Levenshtein automata, so a misspelled term is found with its distance. Each hit is weighed by its context: quotation marks and
words of reporting around it speak for quotation, words of address for abuse. A logistic model over the sums scores the document.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import FILTER_BITS, bit_filter, materialize, release_memory, strata, tidy

# Words of address and of reporting in English, German, French and Spanish, and characters that stand for letters.
ADDRESS = frozenset("you your you're u du dein deine ihr euer tu toi ton ta vous votre tú usted ustedes vuestro eres".split())
REPORT = frozenset("said says called quoted quote wrote word words term sagte schrieb zitat wort dit écrit cite mot dijo escribió cita palabra".split())
QUOTES = "\"'“”„«»‘’‚"
LOOKS_LIKE = str.maketrans("013457@$", "oieastas")
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + QUOTES + "…–—¿¡"
WINDOW = 6
CACHED_WORDS, MOST_STATES = 100_000, 50_000


def clean(token: str) -> str:
    """A token as the lexicon has it: lower case, without marks at its edges."""
    return token.lower().strip(EDGES)


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 12 else 2


class FuzzyLexicon:
    """Levenshtein automata of all terms at once, intersected with their trie and made deterministic as words are met.

    A state is the set of (trie node, edits so far) that a word's prefix can be in, kept as packed numbers; ``match`` follows one
    transition per character and stops when the set is empty. Beyond ``MOST_STATES`` states they are built anew.
    """

    def __init__(self, terms: list[str]):
        self.child: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most = [0]  # edits that any term below a node allows
        for t, term in enumerate(terms):
            node, k = 0, allowed_edits(term)
            self.most[0] = max(self.most[0], k)
            for c in term:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            self.term[node] = t
        self.edits = [allowed_edits(t) for t in terms]
        self._begin()

    def _begin(self) -> None:
        self.states: dict[bytes, int] = {}
        self.sets: list[bytes] = []
        self.delta: list[dict[str, int]] = []
        self.accept: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        todo = list(items)
        while todo:  # letters of the term that the word leaves out
            node, e = todo.pop()
            if e > self.most[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            todo += [(n, e + 1) for n in self.child[node].values()]
        key = array("I", sorted(4 * node + e for node, e in best.items())).tobytes()
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.delta.append({})
            hits = [(e, self.term[n]) for n, e in best.items() if self.term[n] >= 0 and e <= self.edits[self.term[n]]]
            self.accept.append(min(hits) if hits else None)
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        out = set()
        packed = array("I")
        packed.frombytes(self.sets[state])
        for node, e in (divmod(k, 4) for k in packed):
            out.add((node, e + 1))  # an extra letter
            for x, n in self.child[node].items():
                out.add((n, e + (x != c)))
        self.delta[state][c] = nxt = self._state(out)
        return nxt

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term within its allowed edits, or None."""
        if len(self.sets) > MOST_STATES:
            self._begin()
        s = self.start
        for c in word:
            nxt = self.delta[s].get(c)
            s = self._step(s, c) if nxt is None else nxt
            if not self.sets[s]:
                return None
        found = self.accept[s]
        return found and (found[1], found[0])


FEATURES = ("terms", "weight", "misspelled", "quoted", "addressed", "density", "distinct")


class Scorer:
    """Features of texts; keeps what each token of the text means once it is met."""

    def __init__(self, lexicon: list[tuple[str, float]]):
        self.weights = [w for _, w in lexicon]
        self.fuzzy = FuzzyLexicon([t for t, _ in lexicon])
        self.known: dict[str, int] = {}

    def _learn(self, tokens: list[str]) -> None:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for t in tokens:
            if t not in self.known:
                w = clean(t)
                hit = self.fuzzy.match(w) if w else None
                if hit is None and w and not w.isalpha():  # only these hold characters that stand for letters
                    hit = self.fuzzy.match(w.translate(LOOKS_LIKE))
                self.known[t] = 0 if hit is None else 1 + 4 * hit[0] + hit[1]

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        try:
            codes = np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens))
        except KeyError:
            self._learn(tokens)
            codes = np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens))
        at = np.flatnonzero(codes)
        if not len(at):
            return [0.0] * len(FEATURES)
        total = weight = wrong = quoted = addressed = 0.0
        for i in at:
            term, edits = divmod(int(codes[i]) - 1, 4)
            near = tokens[max(0, i - WINDOW) : i + WINDOW + 1]
            words = {clean(t) for t in near}
            marks = any(t[0] in QUOTES for t in near[: WINDOW + 1]) and any((t.rstrip(".,;:!?")[-1:] or " ") in QUOTES for t in near[min(i, WINDOW) :])
            is_quote = bool(marks or words & REPORT)
            total += 1
            weight += self.weights[term] / (1 + edits)
            wrong += edits > 0
            quoted += is_quote
            addressed += bool(words & ADDRESS) and not is_quote
        return [math.log1p(total), weight / total, math.log1p(wrong), math.log1p(quoted), math.log1p(addressed), min(1.0, 20 * total / len(tokens)), math.log1p(len({int(codes[i] - 1) // 4 for i in at}))]


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def labelled(labels: DataFrame) -> DataFrame:
    """(label_id, toxic) of the labels that are not held out."""
    return labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id")).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """At most ``most`` labelled rows that are not held out, in order of a hash of their id: id, text, toxic, weight.

    If there are more, up to half of them are toxic ones and up to half the others, as far as there are so many; weight is the number of
    labelled rows that a row of its kind stands for. Documents may repeat a labelled id: of all of them at most ``most`` stay.
    """
    marked = labelled(labels)
    n = {r.toxic: r.n for r in marked.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    k = strata(n.get(0, 0), n.get(1, 0), most)
    of = [marked.where((F.col("toxic") == 1) == bool(t)).orderBy(F.xxhash64("label_id"), "label_id").limit(k[t]).withColumn("weight", F.lit(n.get(t, 0) / max(1, k[t]))) for t in (0, 1)]
    rows = texts_of(docs, id_col, text_col).join(F.broadcast(of[0].unionByName(of[1])), F.col("id") == F.col("label_id"))  # at most ``most`` rows of three numbers
    rows = materialize(rows.select("id", "text", "toxic", "weight", F.xxhash64("id", "text").alias("order_")), "labelled")
    return rows.orderBy("order_").limit(most).drop("order_")


def words_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(words, toxic): the distinct words of each labelled row that is not held out, one to a line.

    Words are taken where the texts are read, and only they are joined to the labels. A filter of bits on the labelled ids, of fixed
    size, spares the work for most other rows.
    """
    marked = labelled(labels)
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)).alias("slot")
    wanted = docs.sparkSession.sparkContext.broadcast(bit_filter(marked.select(slot(F.col("label_id").cast("string"))), "slot"))

    def distinct(batches):
        forms: dict[str, str] = {}
        bits = wanted.value
        for batch in batches:
            keys, words = [], []
            for key, at, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if not bits[at >> 3] >> (at & 7) & 1:
                    continue
                found = set()
                for t in set(text.split()):
                    w = forms.get(t)
                    if w is None:
                        w = forms[t] = clean(t)
                    found.add(w)
                if len(forms) > CACHED_WORDS:
                    forms.clear()
                keys.append(key)
                words.append("\n".join(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string())], names=["key", "words"])

    texts = texts_of(docs, id_col, text_col).select(F.col("id").cast("string").alias("key"), slot(F.col("id").cast("string")), "text")
    return texts.mapInArrow(tidy(distinct), "key string, words string").join(marked, F.col("key") == F.col("label_id").cast("string")).select("words", "toxic")


def learn_lexicon(rows: DataFrame, most_terms: int | None = 400, least_docs: int = 4, least_ratio: float = 20.0) -> list[tuple[str, float]]:
    """Words that stand out in the toxic ones of ``rows`` (words, toxic), with the log of their smoothed ratio; at most ``most_terms``,
    the most telling first, or all with None.

    Counts are document frequencies, so a word counts once for a document. Words need ``least_docs`` toxic documents and a share
    among them that is ``least_ratio`` times the share among the others. Each task counts its words before they are shuffled, and only
    the terms are collected.
    """

    def sums(counts):
        words = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(words, pa.string())] + [pa.array([c[w] for w in words], pa.int64()) for c in (counts[1], counts[0])]
        return pa.RecordBatch.from_arrays(columns, names=["word", "a", "b"])

    def count(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic == 1].update({"", *words.split("\n")})  # '' stands for the document
                if len(counts[0]) + len(counts[1]) > CACHED_WORDS:
                    yield sums(counts)
                    counts = (Counter(), Counter())
        yield sums(counts)

    counts = rows.select("words", "toxic").mapInArrow(tidy(count), "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = materialize(counts.where((F.col("a") >= least_docs) | (F.col("word") == "")), "words")
    n = counts.where("word = ''").first()
    if not n or not n.a or not n.b:
        return []
    ratio = F.log(((F.col("a") + 0.5) / (n.a + 1)) / ((F.col("b") + 0.5) / (n.b + 1)))
    best = counts.where((F.col("a") >= least_docs) & (F.length("word") >= 3)).withColumn("w", ratio).where(F.col("w") >= math.log(least_ratio))
    best = best.orderBy(F.desc(F.col("w") * F.sqrt("a")), "word")
    return [(r.word, r.w) for r in (best if most_terms is None else best.limit(most_terms)).collect()]


def feature_udf(lexicon: list[tuple[str, float]]):
    """A column function: the features of a text as an array, in the order of FEATURES."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(lexicon)
        for texts in batches:
            yield pd.Series([scorer.features(t or "") for t in texts], dtype=object)
        del scorer
        release_memory()

    return features


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 40, c: np.ndarray | float = 1.0) -> np.ndarray:
    """Weights and, last, the intercept of a ridge logistic model of rows that count ``c`` times, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, l2), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (c * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    """A learned lexicon and the weights of the logistic model; no weights if there was nothing to learn from."""

    lexicon: list[tuple[str, float]]
    weights: list[float] | None

    def features(self, text: F.Column) -> F.Column:
        return feature_udf(self.lexicon)(text)

    def score(self, features: F.Column) -> F.Column:
        if self.weights is None:
            return F.lit(0.0)
        z = F.lit(self.weights[-1])
        for k, v in enumerate(self.weights[:-1]):
            z = z + features[k] * F.lit(v)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_train: int = 20_000, most_terms: int | None = 400) -> ToxicityModel:
    """Learn the lexicon from all labelled rows that are not held out, and the weights from at most ``most_train`` of them; only texts enter."""
    lexicon = learn_lexicon(words_of(docs, labels, id_col, text_col), most_terms)
    if not lexicon:
        return ToxicityModel([], None)
    train = train_rows(docs, labels, id_col, text_col, most_train)
    known = train.select("id", "toxic", "weight", feature_udf(lexicon)("text").alias("x")).orderBy("id").collect()  # most_train rows of numbers
    w = fit_logistic(*(np.array([r[k] for r in known], float) for k in ("x", "toxic")), c=np.array([r.weight for r in known]))
    return ToxicityModel(lexicon, [float(v) for v in w])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_train: int = 20_000, most_terms: int | None = 400) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits, quoted) for every row of ``docs``.

    Learns only from rows of ``labels`` (doc_id, toxic) with crc32(doc_id as text) mod 5 other than 0: the lexicon from all of these (of
    its terms the ``most_terms`` most telling, or all with None), the weights from at most ``most_train``, drawn by kind; no column but the text enters a score. hits counts lexicon terms, quoted those
    in quotation. Null and empty texts have the score of a text without hits. Rows that repeat an id in ``labels`` count as labels each. With labels of one kind or none, all scores are 0. Rows that repeat each get a row; a null
    id has held_out null. An empty table gives an empty result. Extra columns are ignored.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, most_train, most_terms)
    rows = docs.select(F.col(id_col).alias("doc_id"), model.features(F.col(text_col).cast("string")).alias("x"))
    out = rows.select("doc_id", held_out("doc_id").alias("held_out"), model.score(F.col("x")).alias("score"), "x")
    count = lambda k: F.round(F.exp(F.col("x")[k]) - 1).cast("int")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), count(0).alias("hits"), count(3).alias("quoted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with their columns; no shuffle once the model is learned.

    Null and empty texts stay, and so do all rows where the labels are of one kind or none. Repeats and null ids are rows like any
    others. An empty table gives an empty result.
    """
    model = fit_toxicity(docs, labels, id_col, text_col)
    return docs.where(model.score(model.features(F.col(text_col).cast("string"))) < 0.5)
