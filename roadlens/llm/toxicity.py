"""Operator 4, toxicity: a learned lexicon, matched with Levenshtein automata, judged by its context.

1. From one half of a bounded labelled sample Spark counts in how many toxic and clean texts each word
   occurs outside quotations, and the stems (first letters) of words likewise; those far more frequent in toxic texts are the
   lexicon.  A stem stands for the compounds that begin with it and ends in ``*``.
2. The lexicon is a trie.  A word of a text that is no term itself is read against the trie by a bit-parallel
   Levenshtein automaton of the word.  An edit is a letter (a code point) that is wrong, missing or added, or two
   neighbours that are swapped.  Terms of FUZZY_FROM letters or more are found within one edit, of TWO_FROM or more
   within two, the nearest first.
3. Each hit is looked at in a window of words: behind an opening and before a closing quotation mark it is quoted,
   else it is abuse.  An apostrophe opens before a word and closes after one.
4. Exact, misspelled, weakly misspelled (terms of SURE_FROM letters less) and quoted hits of a text are inputs of a
   logistic regression, fitted on the other half of the sample.

Defined results: null and empty texts have no hits and get the score of a text without hits; null ids are
scored like others with ``held_out`` null; without labels of both classes every score is the share of label
1 (0 without labels); a column that is called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import SAMPLE_ROWS, append_columns, fold, labelled_sample, stage
from roadlens.llm.words import LOOK_UP_BYTES, Block, Memory, blocks, distinct, keyed, segment_hash

LEAST_TOXIC = 3
LEAST_LOG_ODDS = 3.0
#: Bytes of a stem.
STEMS = (4, 5, 6)
#: Letters a term needs for one edit, for a misspelling to be no weak sign, and for two edits.
FUZZY_FROM, SURE_FROM, TWO_FROM = 4, 5, 8
#: Bytes of a term at most.
LONGEST = 64
CONTEXT = 6
PREDICT_FROM = 0.5

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _folded(b: Block) -> np.ndarray:
    """The block's lower-cased bytes with the Latin-1 capitals lowered too, and typographic marks as blanks."""
    data = b.data.copy()
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    data[capital] += 0x20
    latin = np.flatnonzero(data[:-1] == 0xC2)
    data[latin], data[latin + 1] = 0x20, 0x20
    general = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
    for j in range(3):
        data[general + j] = 0x20
    return data


def _quotes(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Words that bear a mark which can open a quotation, and one which can close it.

    All quotation marks can do both, as languages differ, but an apostrophe opens only at a word's beginning and closes at its end.
    """
    at = b.data
    first, last = at[b.start], at[b.end - 1]
    marked = (first == 0x22) | (last == 0x22)
    padded = np.concatenate((at, np.zeros(3, dtype=np.uint8)))
    second, third = padded[b.start + 1], padded[b.start + 2]
    typographic = lambda x: (x >= 0x98) & (x <= 0x9F)
    marked |= (first == 0xE2) & (second == 0x80) & typographic(third)
    marked |= (first == 0xC2) & ((second == 0xAB) | (second == 0xBB))
    before = padded[np.maximum(b.end - 2, 0)]
    marked |= ((last == 0xAB) | (last == 0xBB)) & (before == 0xC2)
    marked |= typographic(last) & (padded[np.maximum(b.end - 3, 0)] == 0xE2)
    return marked | (first == 0x27), marked | (last == 0x27)


def in_quotes(b: Block, word: np.ndarray) -> np.ndarray:
    """Which of the given words have an opening mark at most CONTEXT words before them and a closing one after (or bear them)."""
    opening, closing = (np.concatenate(([0], np.cumsum(x))) for x in _quotes(b))
    begin = np.concatenate(([0], np.cumsum(b.per_doc(b.doc).astype(np.int64))))
    doc = b.doc[word]
    before = np.maximum(word - CONTEXT, begin[doc])
    after = np.minimum(word + CONTEXT + 1, begin[doc + 1])
    return (opening[word + 1] > opening[before]) & (closing[after] > closing[word])


def terms_of(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, start, end, folded bytes): the words of a block without the marks around their letters."""
    data = _folded(b)
    letters = np.flatnonzero(_LETTER[data])
    if not len(letters) or not len(b.start):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, data
    low, high = np.searchsorted(letters, b.start), np.searchsorted(letters, b.end)
    has = np.flatnonzero(high > low)
    return has, letters[low[has]], letters[high[has] - 1] + 1, data


def edits_allowed(n: int) -> int:
    """Edits within which a term of n letters is found."""
    return 0 if n < FUZZY_FROM else 1 if n < TWO_FROM else 2


def without_letters(word: str, edits: int) -> set[str]:
    """The word with up to ``edits`` letters left out.

    Words within that many edits of each other have such a rest in common: each edit leaves out at most one letter of either.
    """
    out = last = {word}
    for _ in range(edits):
        last = {w[:i] + w[i + 1:] for w in last for i in range(len(w))}
        out = out | last
    return out


_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def rest_hashes(words: list[str], edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of :func:`without_letters` of all words, one way to leave letters out after another.

    A word's hash is the sum of its letters times powers of a base; letters behind a gap are moved by its inverse.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        powers = np.array([pow(_BASE, p, 1 << 64) for p in range(n)], dtype=np.uint64)
        upto = np.zeros((len(at), n + 1), dtype=np.uint64)
        np.cumsum((letters[begin[at][:, None] + np.arange(n)] + np.uint64(1)) * powers, axis=1, out=upto[:, 1:])
        upto = upto.T.copy()
        yield at, upto[n]
        for i in range(n if edits else 0):
            yield at, upto[i] + _BACK * (upto[n] - upto[i + 1])
            for j in range(i + 1, n if edits > 1 else 0):
                yield at, upto[i] + _BACK * (upto[j] - upto[i + 1] + _BACK * (upto[n] - upto[j + 1]))


class Rests:
    """Which words share a rest with a term, by hashes; a few others pass as well."""

    def __init__(self, terms: list[str], edits: int) -> None:
        self.edits = edits
        self.hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, h in rest_hashes(terms, edits)]]))
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.hashes >> np.uint64(44)] = True

    def shared(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words), dtype=bool)
        if len(self.hashes):
            for at, hashes in rest_hashes(words, self.edits):
                some = np.flatnonzero(self.seen[hashes >> np.uint64(44)])
                place = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
                out[at[some[self.hashes[place] == hashes[some]]]] = True
        return out


@dataclass
class Trie:
    """Lexicon terms (text) as nested dicts; key None holds the term's number and its letters, key "" the node's number."""

    terms: list[str]
    root: dict = field(default_factory=lambda: {"": 0})
    #: terms by what is left of them without one letter, and of long ones without two
    rests: tuple[dict, dict] = field(default_factory=lambda: ({}, {}))
    #: numbers of the nodes on the way to each term
    paths: dict[int, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        nodes = 1
        for number, term in enumerate(self.terms):
            edits = edits_allowed(len(term))
            if not edits or term.endswith("*"):
                continue
            node, path = self.root, []
            for c in term:
                if c not in node:
                    node[c] = {"": nodes}
                    nodes += 1
                node = node[c]
                path.append(node[""])
            node[None] = (number, len(term))
            self.paths[number] = path
            for found, n in zip(self.rests, range(1, edits + 1)):  # noqa: B905 - shorter terms allow one edit
                for rest in without_letters(term, n):
                    found.setdefault(rest, []).append(number)
        long = [self.terms[i] for i in self.paths if edits_allowed(len(self.terms[i])) > 1]
        self.filters = (Rests([self.terms[i] for i in self.paths], 1), Rests(long, 2))

    def candidates(self, words: list[str]) -> dict[int, list[int]]:
        """Terms that share a rest with a word (by its place): all that are near it, and a few others."""
        out: dict[int, set[int]] = {}
        for rests, some in zip(self.rests, self.filters, strict=True):
            for i in np.flatnonzero(some.shared(words)).tolist():
                for rest in without_letters(words[i], some.edits):
                    if rest in rests:
                        out.setdefault(i, set()).update(rests[rest])
        return {i: sorted(x) for i, x in out.items()}

    def nearest(self, word: str, wanted: list[int]) -> int:
        """Number of the term of the fewest edits, at most what its length allows (of equal ones the smallest), or -1.

        ``now[e]`` are the states of the word's automaton after a path of the trie: bit i says that the path matches
        the first i letters with up to e edits; ``past`` are those a letter earlier, for swaps.  Only paths to the
        ``wanted`` terms are followed.
        """
        if not wanted:
            return -1
        open_nodes = {node for number in wanted for node in self.paths[number]}
        edits = max(edits_allowed(len(self.terms[number])) for number in wanted)
        goal, every, masks = 1 << len(word), (2 << len(word)) - 1, {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | (1 << i)
        best = (edits + 1, -1)
        waiting = [(self.root, tuple((2 << e) - 1 & every for e in range(edits + 1)), (0,) * (edits + 1), 0)]
        while waiting:
            node, now, past, last = waiting.pop()
            for c, child in node.items():
                if c is None:
                    number, n = child
                    fewest = next((e for e in range(min(edits, edits_allowed(n)) + 1) if now[e] & goal), None)
                    if fewest is not None and (best[1] < 0 or (fewest, number) < best):
                        best = (fewest, number)
                    continue
                if c == "" or child[""] not in open_nodes:
                    continue
                mask = masks.get(c, 0)
                following = [(now[0] & mask) << 1]
                for e in range(1, edits + 1):
                    following.append((((now[e] & mask) << 1) | now[e - 1] | (now[e - 1] << 1) | (following[e - 1] << 1)
                                      | ((((past[e - 1] & mask) << 1) & last) << 1)) & every)
                if following[-1]:
                    waiting.append((child, tuple(following), now, mask))
        return best[1]


FEATURES = ["exact", "misspelled", "weak", "quoted", "exact_share", "misspelled_share", "distinct_terms", "strongest"]


@dataclass
class Model:
    """A lexicon with log odds by term, and the regression; ``constant`` is the score if there is no model."""

    terms: list[bytes] = field(default_factory=list)
    log_odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0


class Matcher:
    def __init__(self, model: Model) -> None:
        self.model = model
        texts = [t.decode("utf-8", "replace") for t in model.terms]
        self.trie = Trie(texts)
        self.weak = np.array([len(t) < SURE_FROM for t in texts], dtype=bool)
        self.numbers = {t: i for i, t in enumerate(model.terms)}
        self.memory = Memory(2)

    def match(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(number of the term or -1, 1 if it is misspelled) of each word."""
        out, others = [(-1, 0)] * len(words), []
        for i, word in enumerate(words):
            number = self.numbers.get(word, -1)
            for n in reversed(STEMS) if number < 0 else ():
                if n < len(word) and (number := self.numbers.get(word[:n] + b"*", -1)) >= 0:
                    break
            if number >= 0:
                out[i] = (number, 0)
            elif len(word) <= LONGEST + 8:  # two letters of four bytes more
                others.append(i)
        texts = [words[i].decode("utf-8", "replace") for i in others]
        for at, wanted in self.trie.candidates(texts).items():
            out[others[at]] = (self.trie.nearest(texts[at], wanted), 1)
        return out

    def _numbers(self, hashes: np.ndarray, word: Callable[[int], bytes]) -> np.ndarray:
        """:meth:`match` of distinct words, remembered by their hashes."""
        memory = self.memory
        if len(memory.hashes) + len(hashes) > memory.most:
            memory.clear()
        new = np.flatnonzero(~np.isin(hashes, memory.hashes)).tolist()
        found = dict(zip(new, self.match([word(i) for i in new]), strict=True))
        return memory.look_up(hashes, found.__getitem__)

    def features(self, text: pa.Array) -> np.ndarray:
        parts = [self._block(b) for b in blocks(text, lower=True, size=LOOK_UP_BYTES)]
        return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))

    def _block(self, b: Block) -> np.ndarray:
        word, start, end, data = terms_of(b)
        values, first, inverse = distinct(segment_hash(data, start, end - start))
        raw = data.tobytes()
        found = self._numbers(values, lambda i: raw[start[first[i]]:end[first[i]]])[inverse]
        hit = found[:, 0] >= 0
        word, number, misspelled = word[hit], found[hit, 0], found[hit, 1] == 1
        doc, quoted = b.doc[word], in_quotes(b, word)
        n_words = b.per_doc(b.doc)
        faint = misspelled & (self.weak[number] if len(number) else False)
        exact, near, weak = ~quoted & ~misspelled, ~quoted & misspelled & ~faint, ~quoted & faint
        count = lambda mask: b.per_doc(doc[mask])
        strongest = np.zeros(b.n_docs)
        np.maximum.at(strongest, doc[exact], self.model.log_odds[number[exact]] if len(number) else 0)
        _, at = np.unique(keyed(number[~quoted].astype(np.uint64), doc[~quoted]), return_index=True)
        size = np.maximum(n_words, 1)
        return np.stack((np.log1p(count(exact)), np.log1p(count(near)), np.log1p(count(weak)), np.log1p(count(quoted)),
                         count(exact) / size, count(near) / size, np.log1p(b.per_doc(doc[~quoted][at])), strongest), axis=1)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts with label 1, texts with label 0) within a batch of (label, text); terms are words and stems."""
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for b in blocks(batch.column(1), lower=True):
            word, start, end, data = terms_of(b)
            meant = ~in_quotes(b, word)
            word, start, end = word[meant], start[meant], end[meant]
            for n in (0, *STEMS):
                of = np.flatnonzero(end - start > n)
                to = start[of] + n if n else end[of]
                hashes, doc = segment_hash(data, start[of], to - start[of]), b.doc[word[of]]
                _, once = np.unique(keyed(hashes, doc), return_index=True)
                values, first, inverse = distinct(hashes[once])
                toxic = labels[b.lo + doc[once]] == 1
                ones = np.bincount(inverse, toxic, len(values)).astype(np.int64)
                zeros = np.bincount(inverse, ~toxic, len(values)).astype(np.int64)
                at = once[first]
                terms = [data[s:e].tobytes() + b"*" * (n > 0) for s, e in zip(start[of[at]], to[at], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(ones), pa.array(zeros)],
                                                 names=["term", "ones", "zeros"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 25) -> np.ndarray:
    """Newton's method on standardised inputs; the last weight is the free constant."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and regression from at most ``sample_rows`` labelled documents that are not held out."""
    sample = stage(
        labelled_sample(docs, labels, label, sample_rows)
        .withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))), "op4-sample")  # equal texts share a half
    halves = {(r["half"], r["label"]): r["n"] for r in sample.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = (sum(n for (_, v), n in halves.items() if v == k) for k in (1, 0))
    if not ones or not zeros:
        return Model(constant=1.0 if ones else 0.0)
    first = sample.where("half = 0").select("label", "text")
    counts = first.mapInArrow(_term_counts, "term binary, ones long, zeros long")
    toxic, clean = halves.get((0, 1), 0), halves.get((0, 0), 0)
    odds = F.log((F.col("ones") + 0.5) / (toxic + 1.0)) - F.log((F.col("zeros") + 0.5) / (clean + 1.0))
    lexicon = (
        counts.groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .where((F.col("ones") >= LEAST_TOXIC) & F.length("term").between(3, LONGEST)).withColumn("odds", odds)
        .where(F.col("odds") >= LEAST_LOG_ODDS).orderBy(F.desc("odds"), "term").collect())
    model = Model([bytes(r["term"]) for r in lexicon], np.array([r["odds"] for r in lexicon], dtype=float))
    second = sample.where("half = 1")
    rows = match_features(second, model, ["doc_id", "label"]).orderBy("doc_id", "label").collect()
    x = np.array([r["features"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(np.unique(y)) < 2:
        return Model(constant=ones / (ones + zeros))
    model.mean, model.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 0.05)
    model.weights = fit_logistic((x - model.mean) / model.spread, y)
    return model


def match_features(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    held: list[Matcher] = []

    def compute(text: pa.Array) -> list[pa.Array]:
        if not held:
            held.append(Matcher(model))
        return [pa.array(list(held[0].features(text)), pa.list_(pa.float64()))]

    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])
    return append_columns(docs, "text", schema, compute, carry)


def apply_toxicity(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 from 0.5 up)."""
    held: list[Matcher] = []

    def compute(text: pa.Array) -> list[pa.Array]:
        if model.weights is None:
            score = np.full(len(text), model.constant)
        else:
            if not held:
                held.append(Matcher(model))
            z = (held[0].features(text) - model.mean) / model.spread
            score = 1 / (1 + np.exp(-np.clip(z @ model.weights[:-1] + model.weights[-1], -30, 30)))
        return [pa.array(score), pa.array((score >= PREDICT_FROM).astype(np.int32))]

    schema = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return append_columns(docs, text_col, schema, compute, carry)


def toxicity(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Fit on the labels that are not held out, then score every document."""
    return apply_toxicity(docs, fit_toxicity(docs, labels), carry=carry).withColumn("held_out", fold() == 0)
