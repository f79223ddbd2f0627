"""Toxicity by a learned lexicon, misspellings included, and the context of each hit.

1. ``learn``: terms (words, and word beginnings for inflected ones) in LEAST
   toxic texts whose document frequency there exceeds that in others by far.
   Neither bound grows with the number of documents, and all such terms count.
2. ``FuzzyLexicon``: Levenshtein automata of all terms run on the lexicon's trie
   at once. A state is a set of (trie node, errors so far); states and their
   transitions are made when first met and kept, so a word costs one lookup
   per letter and most words end after a few. Words of four letters and more
   and beginnings of five and more may have one error, of nine and more two; a
   swap of neighbouring letters counts as one. ``grade`` tells hits with errors
   apart by length and errors. Words that clean texts hold of themselves
   (``clean_neighbours``) are no misspellings.
3. ``features``: hits, weighted by their context windows: within quotation marks
   or near a reporting word they count apart from abuse.
4. A logistic model on these features gives the score. It also learns from each
   document with its exact hits misspelled, under the same label.

Lexicon and model learn from at most ``SAMPLE`` labelled documents that are not
held out (those with the smallest hashes of their id); scores cover all rows.

Null and empty texts have no hits and get the score of such texts. Labels other
than 0 and 1 and null ids are not learned from. With labels of one kind only,
or none, there is no lexicon and every score is the share of toxic ones (0
without labels). Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopgrid.llm.common import held_out, text_or_empty

SAMPLE = 12_000
LIFT = 2.5            # least log ratio of document frequencies
LEAST = 8             # least number of toxic documents with a term
WINDOW = 60           # characters looked at on either side of a hit
WORD = re.compile(r"[^\W\d_]+")
KNOWN = 500_000       # words remembered by a task
# Quotation marks and reporting words.
OPENING, CLOSING = "\"“„«‹", "\"”“»›"
REPORTING = frozenset("said says quote quoted called wrote word term dit dijo sagte schrieb mot wort palabra".split())


def allowed_errors(term: str) -> int:
    n = len(term.rstrip("*"))
    if n < 4 + term.endswith("*"):
        return 0
    return 1 if n < 9 else 2


# Grades of hits with errors: a word of 4, of 5 or 6, and of more letters with one error; a beginning with one; two errors.
SHORT, MIDDLE, LONG, STEM, TWO = GRADES = range(2, 7)


class FuzzyLexicon:
    """``match(word)``: 0 no term, 1 a term, 2 a term with errors. ``grade(word)``: 0, 1 or one of GRADES; 0 for ``clean`` words."""

    def __init__(self, terms: list[str], clean: frozenset = frozenset()):
        self.clean, self.words = clean, frozenset(t for t in terms if not t.endswith("*"))
        self.stems = frozenset(t[:-1] for t in terms if t.endswith("*"))
        self.stem_sizes = sorted({len(t) for t in self.stems})
        self.sizes: list[int] = [0]         # letters of a node
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}      # node -> errors allowed there
        self.absorbs: dict[int, int] = {}   # nodes at which a beginning is complete -> errors allowed there
        self.reach: list[int] = [0]         # errors allowed by any term below a node
        for term in terms:
            node = 0
            self.reach[0] = max(self.reach[0], allowed_errors(term))
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children.append({})
                    self.reach.append(0)
                    self.sizes.append(self.sizes[node] + 1)
                    self.children[node][letter] = len(self.children) - 1
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], allowed_errors(term))
            if term.endswith("*"):
                self.absorbs[node] = allowed_errors(term)
            else:
                self.ends[node] = allowed_errors(term)
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[int] = []        # the grade
        self.start = self._state({(0, 0)})
        self.known: dict[str, int] = {}

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state for some (node, errors), letters left out of the word included; -1: nothing can match."""
        todo, best = list(pairs), {}
        while todo:
            node, errors = todo.pop()
            if errors > self.reach[node] or best.get(node, 99) <= errors:
                continue
            best[node] = errors
            todo.extend((child, errors + 1) for child in self.children[node].values())
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            exact = any(e == 0 and (n in self.ends or n in self.absorbs) for n, e in key)
            grades = {self._grade(self.sizes[n], e) for n, e in key if e <= self.ends.get(n, -1)}
            grades |= {STEM if e == 1 else TWO for n, e in key if e <= self.absorbs.get(n, -1)}
            self.accepts.append(1 if exact else next((g for g in (LONG, MIDDLE, SHORT, STEM, TWO) if g in grades), 0))
        return self.ids[key]

    @staticmethod
    def _grade(size: int, errors: int) -> int:
        return TWO if errors > 1 else SHORT if size < 5 else MIDDLE if size < 7 else LONG

    def _move(self, state: int, letter: str) -> int:
        pairs = set()
        for node, errors in self.states[state]:
            if node in self.absorbs:
                pairs.add((node, errors))
            pairs.add((node, errors + 1))                    # one letter too many
            for other, child in self.children[node].items():
                pairs.add((child, errors + (other != letter)))
        return self._state(pairs)

    def match(self, word: str) -> int:
        return min(self._run(word), 2)

    def _run(self, word: str) -> int:
        state = self.start
        for letter in word:
            following = self.moves[state].get(letter)
            if following is None:
                following = self._move(state, letter)
                self.moves[state][letter] = following
            if following < 0:
                return 0
            state = following
        return self.accepts[state]

    def _swapped(self, word: str) -> int:
        """The grade of a word that is a term with two neighbouring letters swapped."""
        best = 0
        for i in range(len(word) - 1):
            if word[i] != word[i + 1]:
                turned = word[:i] + word[i + 1] + word[i] + word[i + 2:]
                if turned in self.words:
                    return self._grade(len(word), 1)
                if any(i < n and n > 4 and turned[:n] in self.stems for n in self.stem_sizes):
                    best = STEM
        return best

    def grade(self, word: str) -> int:
        found = self._run(word)
        if found == 1:
            return 1
        if word in self.clean:
            return 0
        if found in (0, TWO) and 4 <= len(word):
            return self._swapped(word) or found
        return found

    def hit(self, word: str) -> int:
        """``grade`` with memory."""
        found = self.known.get(word)
        if found is None:
            found = self.grade(word)
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[word] = found
        return found


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a hit stands in quotation marks or next to a reporting word."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    before = before[before.rfind("\n") + 1:]
    after = after.split("\n", 1)[0]
    opened = max(map(before.rfind, OPENING))
    if opened >= 0 and not any(c in before[opened + 1:] for c in CLOSING) and any(c in after for c in CLOSING):
        return True
    near = WORD.findall(before.lower())[-3:] + WORD.findall(after.lower())[:2]
    return not REPORTING.isdisjoint(near)


FEATURES = 5 + len(GRADES)


def features(text: str, lexicon: FuzzyLexicon) -> list[float]:
    lower = text.lower()
    words = WORD.findall(lower)
    hit = lexicon.hit
    found = [k for w in words if (k := hit(w))]
    row = [1.0] + [0.0] * (FEATURES - 1)
    if found:
        counts = {(kind, said): 0 for kind in (1, *GRADES) for said in (False, True)}
        for m in WORD.finditer(lower):
            if kind := hit(m.group()):
                counts[kind, quoted(lower, *m.span())] += 1
        abuse = counts[1, False]
        row = [1.0, float(abuse > 0), math.log1p(abuse), math.log1p(sum(counts[k, True] for k in (1, *GRADES))),
               min(1.0, 20 * abuse / len(words)), *(math.log1p(counts[k, False]) for k in GRADES)]
    return row


def misspelled(text: str, lexicon: FuzzyLexicon) -> str | None:
    """The text with an error in each exact hit that may have one (drawn from a hash of the text); None without any."""
    rng, changed = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass"))), False

    def put(m: re.Match) -> str:
        nonlocal changed
        word = m.group()
        if len(word) < 4 or lexicon.hit(word.lower()) != 1:
            return word
        i, kind = rng.randrange(len(word) - 1), rng.randrange(4)
        new = (word[:i] + word[i + 1:], word[:i] + word[i] + word[i:], word[:i] + word[i + 1] + word[i] + word[i + 2:],
               word[:i] + rng.choice("aeinorst") + word[i + 1:])[kind]
        if lexicon.hit(new.lower()) == 1:  # still a term, or beginning, as it is
            new = word[0] + word[2:] if lexicon.hit((word[0] + word[2:]).lower()) != 1 else word
        changed |= new != word
        return new

    out = WORD.sub(put, text)
    return out if changed else None


def terms_of(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return {w for w in words if 3 < len(w) < 24} | {w[:n] + "*" for w in words for n in range(4, min(9, len(w)))}


def choose_terms(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int) -> list[str]:
    def lift(t):
        return math.log((toxic[t] + .5) / (n_toxic + 1)) - math.log((other.get(t, 0) + .5) / (n_other + 1))
    good = {t: lift(t) for t in toxic if toxic[t] >= LEAST}
    good = {t: v for t, v in good.items() if v >= LIFT}
    chosen: list[str] = []
    most: dict[str, int] = {}           # string -> largest count of the chosen terms that start with it
    stems: dict[str, int] = {}          # chosen words and beginnings, without the star -> largest count
    absorbing: set[str] = set()
    for t in sorted(good, key=lambda t: (-toxic[t] * good[t], t.endswith("*"), -len(t), t)):
        stem = t.rstrip("*")
        heads = [stem[:n] for n in range(1, len(stem) + 1)]
        # A full word stays next to its beginning: with it goes its allowance of errors.
        if t.endswith("*"):
            near = max([most.get(stem, 0), *(stems.get(h, 0) for h in heads)])
            if any(h in absorbing for h in heads) or near and toxic[t] <= 1.2 * near:
                continue
            absorbing.add(stem)
        chosen.append(t)
        stems[stem] = max(stems.get(stem, 0), toxic[t])
        for h in heads:
            most[h] = max(most.get(h, 0), toxic[t])
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, terms: list[str], weights: np.ndarray, clean: frozenset = frozenset()):
        self.terms, self.weights, self.clean = terms, weights, clean

    def scores(self, texts: list[str]) -> list[float]:
        lexicon = self.__dict__.get("_lexicon") or self.__dict__.setdefault("_lexicon", FuzzyLexicon(self.terms, self.clean))
        x = np.array([features(t, lexicon) for t in texts]).reshape(len(texts), FEATURES)
        return (1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))).tolist()

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "clean": self.clean}


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    usable = labels.where(~held_out(doc_id) & F.col(doc_id).isNotNull() & F.col(toxic).isin(0, 1)).select(
        F.col(doc_id).cast("long").alias("_id"), F.col(toxic).cast("int").alias("_y"))
    sample = F.broadcast(usable.orderBy(F.xxhash64("_id"), "_id", "_y").limit(SAMPLE))  # SAMPLE rows at most
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_or_empty(text).alias("_text")).join(sample, "_id").select("_y", "_text")
    size = {r._y: r.n for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    base = size.get(1, 0) / max(1, sum(size.values()))
    if not size.get(0) or not size.get(1):
        bias = math.log(base / (1 - base)) if 0 < base < 1 else 30.0 * (1 if base else -1)
        return Model([], np.r_[bias, np.zeros(FEATURES - 1)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[y].update(terms_of(t))
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(list(found[y]), pa.string()), pa.array([y] * len(found[y]), pa.int32()),
                                              pa.array(list(found[y].values()), pa.int64())], ["term", "y", "n"])

    both = rows.mapInArrow(counted, "term string, y int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("other"))
    lift = F.log((F.col("toxic") + .5) / (size[1] + 1)) - F.log((F.col("other") + .5) / (size[0] + 1))
    # Terms that toxic documents hold so much oftener, in LEAST of at most SAMPLE documents: bounded, whatever the input.
    often = both.where((F.col("toxic") >= LEAST) & (lift >= LIFT - 1e-6)).collect()
    terms = choose_terms({r.term: r.toxic for r in often}, {r.term: r.other for r in often}, size[1], size[0])

    clean = clean_neighbours(rows, terms, size)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = FuzzyLexicon(terms, clean)
        for batch in batches:
            y, x = [], []
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for version in (t, misspelled(t, lexicon)):
                    if version is not None:
                        y.append(label)
                        x.append(features(version, lexicon))
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    found = rows.mapInArrow(rows_of, "y int, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist()).reshape(-1, FEATURES)
    return Model(terms, fit_logistic(x, found["y"].to_numpy().astype(float)), clean)


def clean_neighbours(rows: DataFrame, terms: list[str], size: dict[int, int]) -> frozenset:
    """Words near a term that two or more clean documents hold and toxic ones not much oftener."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, found = FuzzyLexicon(terms), Counter()
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((w, y) for w in set(WORD.findall(t.lower())) if lexicon.hit(w) > 1)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32()),
                                          pa.array(list(found.values()), pa.int64())], ["word", "y", "n"])

    counts = rows.mapInArrow(run, "word string, y int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("other"))
    lift = F.log((F.col("toxic") + .5) / (size[1] + 1)) - F.log((F.col("other") + .5) / (size[0] + 1))
    # Words near a term in at most SAMPLE documents: bounded, whatever the input.
    return frozenset(r.word for r in counts.where((F.col("other") >= 2) & (lift < LIFT)).select("word").collect())


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                             ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
