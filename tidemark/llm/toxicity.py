"""Toxicity scores from a learned lexicon, fuzzy matching by Levenshtein automata over its trie, and the hits' context."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table, texts

FIT_TOXIC, FIT_CLEAN = 12_000, 16_000  # labelled documents that are looked at, at most (bound of the fit)
CANDIDATES = 50_000  # terms of the toxic documents that are compared with the clean ones, at most
TERMS = 3_000  # terms of the lexicon, at most
EXCEPTIONS = 20_000  # words that look like a term but are ordinary, at most
STEMS = range(4, 9)  # lengths of word beginnings that can be a term
WINDOW = 8  # words on either side of a hit
THRESHOLD = 0.7
# Marks and words that tell of quoting, and words that address somebody.
QUOTES = "\"'“”„«»‘’‚‹›`"
REPORTING = set("said says say quote quoted quotes called calls call word term wrote writes insult sagte sagt zitat nannte dit dite cite appelle dijo dice cita llama".split())
ADDRESS = set("you your you're ur u du dich dir ihr euch tu te toi vous votre usted tú ustedes".split())
WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def terms_of(words: set[str]) -> set[str]:
    """The words and their beginnings (marked with ``*``)."""
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) >= k}


def edits_allowed(term: str) -> int:
    """A whole word may be misspelled from 5 letters on, a beginning from 7; two errors from 9 and 11."""
    n = len(term) - 2 * term.endswith("*")
    return 0 if n < 5 else 1 if n < 9 else 2


class Lexicon:
    """A trie of weighted terms, run as one automaton: its states are sets of (trie node, errors so far).

    The states are those of the terms' Levenshtein automata intersected with the trie. They are made as words need
    them and kept, so a word costs one lookup per letter and most words end in the empty state after a few.
    """

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset()):
        self.exceptions = exceptions
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[float, bool, int]]] = [[]]  # weight, beginning?, allowed errors
        self.slack = [0]  # most errors that a term below allows
        for term, weight in weights.items():
            node, allowed = 0, edits_allowed(term)
            for c in term.rstrip("*"):
                self.slack[node] = max(self.slack[node], allowed)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.slack.append(0)
                node = self.children[node][c]
            self.slack[node] = max(self.slack[node], allowed)
            self.ends[node].append((weight, term.endswith("*"), allowed))
        self._clear()

    def _clear(self) -> None:
        self.moves: list[dict[str, int]] = [{}]
        self.sets = [self._closed({(0, 0)})]
        self.number = {self.sets[0]: 0}
        self.stems = [self._stem(self.sets[0])]
        self.found: dict[str, tuple[float, bool] | None] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With the states that a letter missing in the word leads to; per node the fewest errors."""
        best: dict[int, int] = {}
        todo = list(states)
        while todo:
            node, e = todo.pop()
            if best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(c, e + 1) for c in self.children[node].values() if e < self.slack[c]]
        return frozenset(best.items())

    def _stem(self, states: frozenset) -> tuple[float, int]:
        """Best term that is a beginning and complete here: weight and errors."""
        return max(((w, -e) for node, e in states for w, stem, allowed in self.ends[node] if stem and e <= allowed), default=(0.0, 0))

    def _step(self, state: int, letter: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            if letter in self.children[node]:
                after.add((self.children[node][letter], e))
            if e < self.slack[node]:
                after.add((node, e + 1))  # a letter too many
                after.update((c, e + 1) for c in self.children[node].values() if e < self.slack[c])
        closed = self._closed(after)
        if closed not in self.number:
            self.number[closed] = len(self.sets)
            self.sets.append(closed)
            self.moves.append({})
            self.stems.append(self._stem(closed))
        self.moves[state][letter] = self.number[closed]
        return self.number[closed]

    def _match(self, word: str) -> tuple[float, bool] | None:
        state, best = 0, (0.0, 0)
        for c in word:
            nxt = self.moves[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if not self.sets[state]:
                break
            best = max(best, self.stems[state])
        else:
            best = max(best, max(((w, -e) for node, e in self.sets[state] for w, _, allowed in self.ends[node] if e <= allowed), default=(0.0, 0)))
        if best[0] <= 0 or (best[1] < 0 and word in self.exceptions):
            return None
        return best[0], best[1] == 0

    def match(self, word: str) -> tuple[float, bool] | None:
        """Weight of the best term the word matches and whether it does so without error; None if there is none."""
        if word in self.found:
            return self.found[word]
        if len(self.found) > 300_000 or len(self.sets) > 100_000:
            self._clear()
        out = self.found[word] = self._match(word)
        return out

    def features(self, text: str) -> tuple[list[float], set[str]]:
        """What the score is made of, and the words that matched with errors."""
        words = words_of(text)
        hits = [(i, m) for i, w in enumerate(words) if (m := self.match(w))]
        if not hits:
            return [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, math.log1p(len(words))], set()
        low = text.lower()
        spans = [m.span() for m in WORDS.finditer(low)]
        at = [i for i, _ in hits]
        scores, quoted = [], 0
        for k, (i, (weight, exact)) in enumerate(hits):
            near = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            a, b = spans[i]
            marks = low[max(0, a - 30) : a], low[b : b + 30]
            quote = any(c in QUOTES for c in marks[0]) and any(c in QUOTES for c in marks[1]) or not REPORTING.isdisjoint(words[max(0, i - 4) : i])
            others = sum(abs(j - i) <= WINDOW for j in at[max(0, k - 2 * WINDOW) : k + 2 * WINDOW + 1]) - 1
            quoted += quote
            scores.append(weight * (1.0 if exact else 0.6) * (0.4 if quote else 1.0) * (1 + 0.25 * min(others, 4)) * (1.0 if ADDRESS.isdisjoint(near) else 1.1))
        n, fuzzy = len(hits), {words[i] for i, (_, exact) in hits if not exact}
        return [max(scores), math.log1p(sum(scores)), math.log1p(n), math.sqrt(n / len(words)), quoted / n, sum(not e for _, (_, e) in hits) / n, math.log1p(len(words))], fuzzy


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(toxic, fold, text)`` of a bounded choice of labelled documents outside the held-out third."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out())
    order = F.xxhash64(F.lit(3), "doc_id")
    picked = known.filter("toxic = 1").orderBy(order, "doc_id").limit(FIT_TOXIC).union(known.filter("toxic = 0").orderBy(order, "doc_id").limit(FIT_CLEAN))
    # At most FIT_TOXIC + FIT_CLEAN pairs of numbers, so the broadcast is bounded.
    both = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    once = both.filter("text IS NOT NULL").select("toxic", F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(2)).alias("fold"), "text")
    return table(once, "toxicity-fit")


def _count_terms(docs: DataFrame, only: set[str] | None = None) -> DataFrame:
    """``(term, n)``: documents per term."""
    def counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    def run(parts):
        seen: Counter = Counter()
        for b in parts:
            for t in texts(b):
                terms = terms_of(set(words_of(t.decode(errors="replace"))))
                seen.update(terms if only is None else terms & only)
                if len(seen) > 200_000:  # bounded memory whatever the size of a batch
                    yield counted(seen)
                    seen = Counter()
        yield counted(seen)

    return docs.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(fit: DataFrame) -> dict[str, float]:
    """Terms whose rate among toxic documents is surely (one-sided 95 %) three times that among clean ones, with the log of that ratio."""
    size = {r["toxic"]: r["count"] for r in fit.groupBy("toxic").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return {}
    often = _count_terms(fit.filter("toxic = 1")).filter(F.col("n") >= max(3, toxic // 300))
    candidates = {r["term"]: r["n"] for r in often.orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()}
    if not candidates:
        return {}
    other = {r["term"]: r["n"] for r in _count_terms(fit.filter("toxic = 0"), set(candidates)).collect()}
    sure = {}
    for term, a in candidates.items():
        b = other.get(term, 0)
        ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if (low := ratio - 1.64 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))) > math.log(3):
            sure[term] = low
    # A term says nothing beyond a shorter beginning that is nearly as sure.
    begun = lambda t: any(sure.get(t[:k] + "*", -1.0) >= sure[t] - 0.5 for k in STEMS if k < len(t.rstrip("*")) or k == len(t) and not t.endswith("*"))
    kept = [t for t in sure if not begun(t)]
    return {t: sure[t] for t in sorted(kept, key=lambda t: (-sure[t] * math.sqrt(candidates[t]), t))[:TERMS]}


def _measure(docs: DataFrame, lexicon: Lexicon, keep: list[str], fuzzy: bool = False) -> DataFrame:
    """The columns ``keep``, ``x`` (features) and, if asked for, the words that matched with errors."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", x array<double>, fuzzy array<string>"

    def run(parts):
        lex = shared.value
        for b in parts:
            xs, words = [], []
            for t in texts(b):
                x, f = lex.features(t.decode(errors="replace"))
                xs.append(x)
                words.append(sorted(f) if fuzzy else None)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(xs, pa.list_(pa.float64())), pa.array(words, pa.list_(pa.string()))], [*keep, "x", "fuzzy"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression, bias last, by Newton steps with a ridge penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    The lexicon is learned from one half of a bounded choice of labelled documents, the logistic weights of the
    features from the other half; documents with crc32(doc_id as text) mod 3 = 1 are held out of both. Words that
    match a term only with errors but also occur in clean documents are exceptions. The features are the hits'
    weights in their context (quotation and reporting lower a hit, other hits and address raise it), their number
    and density, the share of quoted and of misspelled hits, and the length. ``predicted`` is 1 from a score of 0.7.

    Only texts are scored: a null or empty text has the score of a text without hits or words. A doc_id labelled
    twice is toxic if any label says so; null ids and null labels are not learned from. Without labels of both
    kinds every score is 0. Malformed UTF-8 is read as U+FFFD. Repeated rows score alike; extra columns are not read;
    an empty table gives no rows.
    """
    fit = _sample(docs, labels)
    weights = learn_lexicon(fit.filter("fold = 0"))
    model, lexicon = None, Lexicon(weights)
    if weights:
        words = _measure(fit, lexicon, ["toxic"], fuzzy=True).select("toxic", F.explode("fuzzy").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
        ordinary = words.filter("n - t >= 1 AND t < 3 * (n - t)").orderBy(F.desc("n"), "word").limit(EXCEPTIONS)
        lexicon = Lexicon(weights, {r["word"] for r in ordinary.collect()})
    rows = _measure(fit.filter("fold = 1"), lexicon, ["toxic"]).select("toxic", "x").toPandas()  # bounded by the fit
    if rows["toxic"].nunique() == 2:
        model = fit_logistic(np.stack(rows["x"].to_numpy()), rows["toxic"].to_numpy(float))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = _measure(keyed, lexicon, ["doc_id"])
    if model is None:
        score = F.lit(0.0)
    else:
        z = F.lit(float(model[-1]))
        for i, w in enumerate(model[:-1]):
            z = z + F.get("x", F.lit(i)) * float(w)
        score = 1 / (1 + F.exp(-z))
    return scored.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
