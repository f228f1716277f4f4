"""Language-model scores by a hierarchical Pitman-Yor model.

A token's context is the word before it. Each such word is a Chinese restaurant whose dishes are the words after it; the
restaurants of all words with one ending share a parent restaurant, those of all endings share the root, whose own base
is uniform over the known words and one unknown. Counts of (word before, word) are kept by word, in hash buckets whose
number follows the size of the input, so the seating of all restaurants at one word is settled in one place. What
restaurants need of each other are the totals of tables: one number per ending and for the root, and one per word
before, which is added up in ranges of contexts and sent back to the buckets where that context stands. A Gibbs sweep
draws the tables of every dish from their conditional, given the totals and parent probabilities of the sweep before.
Random numbers come from the seed, the bucket and the sweep, so a task rebuilds earlier sweeps from the totals alone:
no seating is kept between jobs, and a lost executor changes nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import configure, shared_dir
from .parcels import batch_name
from .shared import buckets_for, pack_gaps, pack_numbers, row_key, table, texts, unpack_gaps, unpack_numbers, word_total

CONTEXTS = 96  # parents of the words' restaurants: the start of a text, and 95 classes of word endings
CONTEXT_BITS = 40  # a word as a context: 33 bits of its hash above its ending's class
BATCH_TOKENS = 1_500_000
BUCKET_TOKENS = 2_500_000
FREQUENT = 200_000  # pairs of words at most that are scored where they stand
SWEEPS, BURN_IN = 4, 1
TABLE = 512  # customers up to which a dish's tables are drawn from a table of Stirling numbers
STEPS = 4  # Metropolis steps per sweep of a dish with more customers, times one and its spread (see ``_others``)
SPREAD = 8.0  # spread from which the number of tables is drawn as a normal one
DRAWS = 1_000_000  # table sizes drawn at once
SEED = 6
BLOCK = 1 << 20  # bytes of text whose words are hashed at a time
GAP = re.compile(rb"[\t-\r ]")


def _ending(last: bytes) -> int:
    """The class of a word's last two bytes, from 1."""
    return 1 + xxhash.xxh32_intdigest(last) % (CONTEXTS - 1)


# A word's hash is the sum of its bytes' random numbers, each times a power that counts the bytes before it.
LOWER = bytes(range(256)).lower()
SPACE = np.array([bytes([c]).isspace() for c in range(256)])
NUMBER = np.array([xxhash.xxh3_64_intdigest(LOWER[c : c + 1], SEED) for c in range(256)], np.uint64)
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)
END = np.uint64(xxhash.xxh3_64_intdigest(b" ") & ~127 | _ending(b" "))  # no word holds a space


@lru_cache(maxsize=1)
def _endings() -> np.ndarray:
    """The class by the last two bytes, the last but one first; words of one byte are at the end."""
    return np.array([_ending(LOWER[a : a + 1] + LOWER[b : b + 1]) for a in range(256) for b in range(256)] + [_ending(LOWER[b : b + 1]) for b in range(256)], np.uint64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int = 2 * BLOCK) -> np.ndarray:
    return np.append(np.uint64(1), np.multiply.accumulate(np.full(n - 1, base, np.uint64)))


def _word_codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, in lower case: 57 bits of its hash above the 7-bit class of its ending, and where it starts."""
    a = np.frombuffer(data, np.uint8)
    edges = np.nonzero(np.diff(SPACE[a], prepend=True, append=True))[0]
    starts, ends = edges[::2], edges[1::2]
    up, down = (_powers(b) if len(a) < 2 * BLOCK else _powers.__wrapped__(b, len(a) + 1) for b in (BASE, pow(BASE, -1, 2**64)))
    sums = np.append(np.uint64(0), np.cumsum(NUMBER[a] * up[: len(a)]))
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ h >> np.uint64(32)) * MIX
    h = (h ^ h >> np.uint64(29)) * MIX
    last = np.where(ends - starts > 1, a[ends - 2].astype(np.int64), 256) * 256 + a[ends - 1]
    return (h ^ h >> np.uint64(32)) & ~np.uint64(127) | _endings()[last], starts


def _coded(some: list[bytes]) -> Iterator[np.ndarray]:
    """The codes of each text's words and its end, worked out for many texts or for a part of a long one at a time."""
    held, size = [], 0

    def together():
        codes, starts = _word_codes(b" ".join(held))
        firsts = np.cumsum([0, *[len(t) + 1 for t in held]])
        cuts = np.searchsorted(starts, firsts)
        out = np.full(len(codes) + len(held), END)
        out[np.arange(len(codes)) + np.repeat(np.arange(len(held)), np.diff(cuts))] = codes
        return [out[a + i : b + i + 1] for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]

    for t in some:
        if held and size + len(t) > BLOCK:
            yield from together()
            held, size = [], 0
        if len(t) > BLOCK:
            parts, at = [], 0
            while len(t) - at > BLOCK and (gap := GAP.search(t, at + BLOCK)):
                parts.append(_word_codes(t[at : gap.start()])[0])
                at = gap.start()
            yield np.concatenate([*parts, _word_codes(t[at:])[0], [END]])
        else:
            held.append(t)
            size += len(t) + 1
    if held:
        yield from together()


@dataclass
class Totals:
    """What a sweep leaves to the next: tables per ending, customers and tables of the root, customers per ending."""

    tables: np.ndarray
    customers: float
    parent_tables: float
    seats: np.ndarray | None = None  # the model's customers, if they are the same in all sweeps


@dataclass
class Model:
    """The training corpus in numbers, and the totals after each sweep. Its size does not depend on the corpus."""

    tokens: int
    known: int
    customers: np.ndarray  # per ending
    discount: float
    parent_discount: float
    totals: list[Totals]  # first with one table per dish, then after each sweep
    strength: float = 1.0
    word_discount: float = 0.5
    least: int = 0  # pairs seen so often are scored where they stand

    def parent_weight(self, totals: Totals) -> float:
        """Weight of a new table of one word in the parent restaurant; also all that the unknown word has."""
        return (self.strength + self.parent_discount * totals.parent_tables) / (self.known + 1)


def seat(counts: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables per dish after its customers sat down one by one; ``weight`` is the dish's weight of a new table.

    This is the process that makes a seating, not the conditional of a sweep (``resample``).
    From the 32nd customer on they come in groups of an eighth of those present, each group seeing the same tables.
    """
    order = np.argsort(-counts, kind="stable")
    n, w, tables = counts[order], weight[order], np.ones(len(counts))
    present, rising = 1, -n
    while True:
        left = int(np.searchsorted(rising, -present))  # dishes with more customers than are present
        if not left:
            break
        group = 1 if present < 32 else present // 8
        new = w[:left] / (present - discount * tables[:left] + w[:left])
        if group == 1:
            tables[:left] += rng.random(left) < new
        else:
            tables[:left] += rng.binomial(np.minimum(group, n[:left] - present).astype(np.int64), new)
        present += group
    out = np.empty_like(tables)
    out[order] = tables
    return out


@lru_cache(maxsize=8)
def stirling(discount: float) -> list[np.ndarray]:
    """By n up to ``TABLE``: logarithms of the generalised Stirling numbers S_d(n, t), t = 1 .. n."""
    rows = [np.empty(0), np.zeros(1)]
    for n in range(1, TABLE):
        joined = np.append(rows[n] + np.log(n - discount * np.arange(1, n + 1)), -np.inf)
        rows.append(np.logaddexp(joined, np.append(-np.inf, rows[n])))
    return rows


@lru_cache(maxsize=8)
def _ratios(discount: float) -> np.ndarray:
    m = np.arange(1, 1000)
    return np.append(0.0, np.cumsum(np.log((m - discount) / m)))


def _log_biased(m: np.ndarray, discount: float) -> np.ndarray:
    """Logarithm of m times the chance of table size m, up to a constant: Gamma(m - d) / Gamma(m) against m = 1."""
    few = _ratios(discount)
    end = len(few) - (discount + 1) / 2
    return np.where(m <= len(few), few[np.minimum(m, len(few)).astype(np.int64) - 1], few[-1] - discount * np.log(np.maximum(m - (discount + 1) / 2, 1) / end))


def _others(n: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator, count: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metropolis steps on the number and joint size of a dish's tables other than that of one customer.

    w^t S_d(n, t) is the chance of t Poisson many tables, w / d expected, of Sibuya(d) sizes, given that the sizes add
    up to n. Proposals are such tables thinned by r^size, with r such that n customers are expected; the customer's own
    table takes the rest. So every step leaves exactly that distribution as it is. The wider the customers of a proposal
    spread (against 1 / -log r, what the own table takes up), the more steps are made; above ``SPREAD``, where tables
    are many, their number is drawn from the normal distribution that the thinned tables have given n customers.
    """
    low, high = np.full(len(n), -80.0), np.full(len(n), -1e-12)
    for _ in range(50):  # (1 - q) q^(d - 1) = n / w with q = 1 - r
        mid = (low + high) / 2
        over = np.log1p(-np.exp(mid)) + (discount - 1) * mid > np.log(n / weight)
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    q = np.exp((low + high) / 2)
    rate, expected = -np.log1p(-q), weight / discount * -np.expm1(discount * np.log(q))
    squares = weight * (1 - q) * (q ** (discount - 1) + (1 - discount) * (1 - q) * q ** (discount - 2))
    spread = rate * np.sqrt(squares)
    wide = spread > SPREAD
    normal = expected + rng.standard_normal(len(n)) * np.sqrt(np.maximum(expected - n * n / squares, 0))
    count, size = np.where(wide, np.clip(np.rint(normal), 1, n) - 1, count), np.where(wide, 0, size)
    todo, left = np.nonzero(~wide)[0], np.ceil(STEPS * (1 + spread))
    while len(todo):
        w, m, rare = weight[todo], n[todo], rate[todo]
        drawn = np.cumsum(rng.poisson(w / discount))
        c, s = np.zeros(len(todo)), np.zeros(len(todo))
        for a in range(0, int(drawn[-1]), DRAWS):
            dish = np.searchsorted(drawn, np.arange(a, min(a + DRAWS, int(drawn[-1]))), "right")
            p = np.clip(rng.beta(discount, 1 - discount, len(dish)), 1e-18, 1 - 1e-15)
            x = 1 + np.floor(-rng.standard_exponential(len(dish)) / np.log1p(-p))
            stay = rng.standard_exponential(len(dish)) > rare[dish] * x
            c += np.bincount(dish[stay], minlength=len(todo))
            s += np.bincount(dish[stay], x[stay], len(todo))
        bias = lambda own, m=m, rare=rare: rare * own + _log_biased(np.maximum(m - own, 1), discount)
        take = (s < m) & (np.log(1 - rng.random(len(todo))) < bias(s) - bias(size[todo]))
        count[todo], size[todo] = np.where(take, c, count[todo]), np.where(take, s, size[todo])
        left[todo] -= 1
        todo = todo[left[todo] > 0]
    return count, size


def resample(counts: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator, chain: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Tables per dish from their Gibbs conditional: t tables of n customers have the chance w^t S_d(n, t).

    Up to ``TABLE`` customers it is drawn directly; above, Metropolis steps go on from the state in ``chain``, at first
    one table (or if the state no longer fits the customers).
    """
    chain = {} if chain is None else chain
    order = np.argsort(counts, kind="stable")
    n, tables = counts[order].astype(np.int64), np.ones(len(counts))
    cuts = np.searchsorted(n, np.arange(TABLE + 2))
    for k in range(2, TABLE + 1):
        for a in range(cuts[k], cuts[k + 1], DRAWS // k):
            at = order[a : min(a + DRAWS // k, cuts[k + 1])]
            chance = np.log(weight[at])[:, None] * np.arange(1, k + 1) + stirling(discount)[k]
            chance = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (chance[:, :-1] <= (rng.random(len(at)) * chance[:, -1])[:, None]).sum(axis=1)
    big = order[cuts[TABLE + 1] :]
    if len(big):
        if not chain:
            chain |= {"count": np.zeros(len(counts)), "size": np.zeros(len(counts))}
        count, size, n = chain["count"][big], chain["size"][big], counts[big].astype(np.float64)
        fits = size < n
        chain["count"][big], chain["size"][big] = _others(n, weight[big], discount, rng, count * fits, size * fits)
        tables[big] = 1 + chain["count"][big]
    return tables


class Bucket:
    """The words of one bucket with their customers per ending, seated in the sweeps that the model has totals for."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, number: int, model: Model):
        self.keys, self.counts, self.model = keys, counts.astype(np.float64), model
        self.context = (keys & np.uint64(127)).astype(np.int64)
        self.words, self.word = np.unique(keys >> np.uint64(7), return_inverse=True)
        self.seen = np.bincount(self.word, self.counts, len(self.words))
        self.tables, self.parent_tables = np.ones(len(keys)), np.ones(len(self.words))
        self.number = number
        self.chain, self.parent_chain = {}, {}
        self.samples: list[tuple[Totals, np.ndarray, np.ndarray, np.ndarray]] = []

    def sweep(self, number: int) -> None:
        """Draw all tables anew, given the totals after sweep ``number - 1``."""
        m, before = self.model, self.model.totals[number - 1]
        rng = np.random.default_rng([SEED, self.number, number])
        weight = (m.strength + m.discount * before.tables[self.context]) * self.parent(before)[self.word]
        self.tables = resample(self.counts, weight, m.discount, rng, self.chain)
        dishes = np.bincount(self.word, self.tables, len(self.words))
        self.parent_tables = resample(dishes, np.full(len(dishes), m.parent_weight(before)), m.parent_discount, rng, self.parent_chain)

    def parent(self, totals: Totals) -> np.ndarray:
        """The parent's probability of each word."""
        m = self.model
        dishes = np.bincount(self.word, self.tables, len(self.words))
        return (dishes - m.parent_discount * self.parent_tables + m.parent_weight(totals)) / (m.strength + totals.customers)

    def probability(self, totals: Totals, counts: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The probability of each dish in the restaurant of its ending."""
        m = self.model
        p = counts - m.discount * tables + (m.strength + m.discount * totals.tables[self.context]) * parent[self.word]
        return p / (m.strength + self.customers(totals)[self.context])

    def customers(self, totals: Totals) -> np.ndarray:
        return self.model.customers if totals.seats is None else totals.seats

    def keep(self, number: int) -> None:
        """Keep the seating of this sweep as a sample, unless it is one of the first few."""
        if number > BURN_IN:
            totals = self.model.totals[number]
            self.samples.append((totals, self.counts, self.tables, self.parent(totals)))

    def sample(self) -> Bucket:
        """Rebuild all sweeps and keep the seatings after the first few."""
        for number in range(1, len(self.model.totals)):
            self.sweep(number)
            self.keep(number)
        return self

    def sampled(self, keys: np.ndarray) -> tuple[np.ndarray, Iterator[np.ndarray]]:
        """For (word, ending) keys: times the word was seen, and its probability in each of the samples."""
        m, word, context = self.model, keys >> np.uint64(7), (keys & np.uint64(127)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.words, word), max(0, len(self.words) - 1))
        known = self.words[at] == word if len(self.words) else np.zeros(len(keys), bool)
        pair = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        paired = self.keys[pair] == keys if len(self.keys) else known

        def probabilities():
            for totals, counts, tables, parent in self.samples:
                base = np.full(len(keys), m.parent_weight(totals) / (m.strength + totals.customers))
                base[known] = parent[at[known]]
                p = (m.strength + m.discount * totals.tables[context]) * base
                p[paired] += counts[pair[paired]] - m.discount * tables[pair[paired]]
                yield p / (m.strength + self.customers(totals)[context])

        seen = np.zeros(len(keys))
        seen[known] = self.seen[at[known]]
        return seen, probabilities()

    def score(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For (word, ending) keys: times the word was seen, and log10 of its probability, averaged over the samples."""
        seen, sampled = self.sampled(keys)
        return seen, np.log10(sum(sampled, np.zeros(len(keys))) / max(1, len(self.samples)))


class Words:
    """The pairs (word before, word) of one bucket, seated in the restaurants of the words before; ``ends`` are their parents.

    A pair seen once has one table in every sweep. So what a sweep needs to know of a context, and changes in its total,
    are the pairs seen more often: only their contexts (``asked``) are sent about.
    """

    def __init__(self, row, model: Model):
        self.words, self.contexts, self.pair, n = _read_counts(row)
        self.model, self.number, self.n = model, int(row["bucket"]), n.astype(np.float64)
        word, self.context = (self.pair >> np.uint64(32)).astype(np.int64), (self.pair & np.uint64(2**32 - 1)).astype(np.int64)
        keys, self.dish = np.unique(self.words[word] | self.contexts[self.context] & np.uint64(127), return_inverse=True)
        self.ends = Bucket(keys, np.bincount(self.dish, minlength=len(keys)), self.number, model)
        self.ends.seen = np.bincount(word, self.n, len(self.words))
        self.many = np.nonzero(n > 1)[0]
        self.asked = np.nonzero(self.per_context(self.many))[0]
        self.place = np.searchsorted(self.asked, self.context[self.many])
        self.tables, self.chain = np.ones(len(n)), {}
        self.samples: list[np.ndarray] = []
        self.totals: dict[int, np.ndarray] = {}

    def per_context(self, pairs: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.context[pairs], None if values is None else values[pairs], len(self.contexts))

    def told(self, rows: pd.DataFrame) -> Words:
        """Take in the totals of the contexts asked about: after which sweep, and in ranges of contexts."""
        rows = rows[rows["kind"] <= len(self.model.totals)].sort_values(["kind", "shard"])
        for kind, of in rows.groupby("kind"):
            self.totals[int(kind)] = np.concatenate([unpack_numbers(x) for x in of["flags"]]).astype(np.float64)
        return self

    def total(self, number: int) -> np.ndarray:
        """Tables of each context asked about after a sweep."""
        return self.totals[ONES] + self.totals[number] if len(self.asked) else np.empty(0)

    def sweep(self, number: int) -> None:
        m = self.model
        rng = np.random.default_rng([SEED, self.number, number, 1])
        before, ends = m.totals[number - 1], self.ends
        below = ends.probability(before, ends.counts, ends.tables, ends.parent(before))[self.dish[self.many]]
        weight = (m.strength + m.word_discount * self.total(number - 1)[self.place]) * below
        self.tables = self.tables.copy()
        self.tables[self.many] = resample(self.n[self.many], weight, m.word_discount, rng, self.chain)
        self.ends.counts = np.bincount(self.dish, self.tables, len(self.ends.keys))
        self.ends.sweep(number)

    def sample(self) -> Words:
        """Rebuild all sweeps and keep the seatings after the first few."""
        for number in range(1, len(self.model.totals)):
            self.sweep(number)
            self.ends.keep(number)
            if number > BURN_IN:
                self.samples.append(self.tables)
        return self

    def pair_scores(self, pairs: np.ndarray | slice, seen: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of pairs, averaged over the samples; ``seen`` and ``tables`` are the totals of their contexts."""
        m, total = self.model, 0.0
        for sample, seated, of in zip(self.ends.samples, self.samples, tables):
            below = self.ends.probability(*sample)[self.dish[pairs]]
            total = total + (self.n[pairs] - m.word_discount * seated[pairs] + (m.strength + m.word_discount * of) * below)
        return np.log10(total / (m.strength + seen) / max(1, len(self.samples)))

    def prepared(self, seen: np.ndarray, tables: list[np.ndarray]) -> Words:
        """Ready to score, given times seen and tables (in each sample) of all contexts."""
        self.context_seen, self.context_tables = seen, tables
        self.logp = self.pair_scores(slice(None), seen[self.context], [t[self.context] for t in tables])
        return self

    def score(self, words: np.ndarray, contexts: np.ndarray, which: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Times that ``words`` were seen, and log10 probability of each ``words[which]`` after ``contexts[of]``."""
        m, word, context = self.model, np.searchsorted(self.words, words), np.searchsorted(self.contexts, contexts)
        if len(contexts) and not (context[-1] < len(self.contexts) and np.array_equal(self.contexts[context], contexts)):
            raise RuntimeError("documents were made anew with other rows; read them from a file or checkpoint")
        known = word < len(self.words)
        known[known] = self.words[word[known]] == words[known]
        times = np.zeros(len(words))
        times[known] = self.ends.seen[word[known]]
        pair = (word.astype(np.uint64) << np.uint64(32))[which] | context.astype(np.uint64)[of]
        place = np.minimum(np.searchsorted(self.pair, pair), max(0, len(self.pair) - 1))
        paired = known[which] & (self.pair[place] == pair) if len(self.pair) else np.zeros(len(pair), bool)
        logp = self.logp[place] if len(self.pair) else np.empty(len(pair))
        rest = np.nonzero(~paired)[0]
        if len(rest):
            at, total = context[of[rest]], 0.0
            _, below = self.ends.sampled(words[which[rest]] | contexts[of[rest]] & np.uint64(127))
            for p, tables in zip(below, self.context_tables):
                total = total + (m.strength + m.word_discount * tables[at]) * p
            logp[rest] = np.log10(total / (m.strength + self.context_seen[at]) / max(1, len(self.samples)))
        return times, logp


# Rows between tasks: counts and requests by bucket of words, totals by range (shard) of contexts and back by bucket.
COUNTS = "bucket int, words binary, contexts binary, pairs binary, places binary, flags binary"
WIRE = "bucket int, batch bigint, kind int, shard int, docs binary, places binary, words binary, contexts binary, pairs binary, flags binary"
SHARD = "shard int, bucket int, sweep int, contexts binary, seen binary, ones binary, tables binary, sums array<double>"
SEEN, ONES, ALL = -2, -1, 1000  # kinds of totals; 0 and above are those after a sweep
ASKED = 2000


def _pack_sorted(values: np.ndarray) -> bytes:
    return pack_numbers(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=np.uint64)


def _counts_row(words: np.ndarray, contexts: np.ndarray, pair: np.ndarray, n: np.ndarray) -> dict:
    """Sorted words and contexts, and the sorted pairs of their places (32 bits each) with their counts; every word has a pair."""
    steps = np.diff(pair >> np.uint64(32), prepend=np.uint64(0)).astype(bool)
    return {"words": _pack_sorted(words >> np.uint64(7)), "contexts": _pack_sorted(contexts), "pairs": np.packbits(steps).tobytes(),
            "places": pack_numbers(pair & np.uint64(2**32 - 1)), "flags": pack_numbers(n)}


def _read_counts(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    of = unpack_numbers(row["places"])
    at = np.cumsum(np.unpackbits(np.frombuffer(row["pairs"], np.uint8))[: len(of)], dtype=np.uint64)
    return _unpack_sorted(row["words"]) << np.uint64(7), _unpack_sorted(row["contexts"]), at << np.uint64(32) | of, unpack_numbers(row["flags"]).astype(np.int64)


def _wire(rows: list[dict], ddl: str = WIRE) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def _frame(rows: list[dict], ddl: str) -> pd.DataFrame:
    names = [f.split()[0] for f in ddl.split(", ")]
    return pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names)


def _dealt(words: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets of words, with the places of their words in rising order."""
    bucket = ((words >> np.uint64(7)) % np.uint64(buckets)).astype(np.uint16 if buckets < 2**16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([[0], np.nonzero(np.diff(bucket[order]))[0] + 1, [len(order)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield int(bucket[order[a]]), order[a:b]


def _codes(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of documents: ids, text hashes, whether held out, tokens per document, each token's word, context and document."""
    dids, ths, outs, codes, n = [], [], [], [], 0

    def batch():
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate(codes)
        context = np.append(np.uint64(0), flat[:-1] >> np.uint64(31) << np.uint64(7) | flat[:-1] & np.uint64(127))
        context[np.cumsum(sizes) - sizes] = 0
        return np.array(dids, np.int64), np.array(ths, np.int64), np.array(outs, bool), sizes, flat & ~np.uint64(127), context, np.repeat(np.arange(len(sizes)), sizes)

    for b in parts:
        for did, th, out, code in zip(b.column("did").to_pylist(), b.column("th").to_pylist(), b.column("held").to_pylist(), _coded(texts(b))):
            if dids and n + len(code) > BATCH_TOKENS:
                yield batch()
                dids, ths, outs, codes, n = [], [], [], [], 0
            dids.append(did)
            ths.append(th)
            outs.append(out)
            codes.append(code)
            n += len(code)
    if dids:
        yield batch()


def count_tokens(docs: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket (``COUNTS``): pairs (word before, word) of the training texts and their counts.

    Contexts of held-out texts are listed too, without a pair, as their totals will be asked for.
    """
    def run(parts):
        for _, _, held, _, word, context, doc in _codes(parts):
            learnt, rows = ~held[doc], []
            for number, at in _dealt(word, buckets):
                contexts, of = np.unique(context[at], return_inverse=True)
                words, which = np.unique(word[at[learnt[at]]], return_inverse=True)
                pair, n = np.unique(which.astype(np.uint64) << np.uint64(32) | of[learnt[at]].astype(np.uint64), return_counts=True)
                rows.append({"bucket": number} | _counts_row(words, contexts, pair, n))
            yield _wire(rows, COUNTS)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        read = [_read_counts(r) for r in pdf.to_dict("records")]
        words, contexts = np.unique(np.concatenate([r[0] for r in read])), np.unique(np.concatenate([r[1] for r in read]))
        pairs, n = [], np.concatenate([r[3] for r in read])
        for i in range(len(read)):
            w, c, pair, _ = read[i]
            which, of = np.searchsorted(words, w).astype(np.uint64), np.searchsorted(contexts, c).astype(np.uint64)
            pairs.append(which[pair >> np.uint64(32)] << np.uint64(32) | of[pair & np.uint64(2**32 - 1)])
            read[i] = None
        pair = np.concatenate(pairs)
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        starts = np.nonzero(np.diff(pair, prepend=~pair[:1]))[0]
        return _frame([{"bucket": pdf["bucket"].iloc[0]} | _counts_row(words, contexts, pair[starts], np.add.reduceat(n, starts) if len(n) else n)], COUNTS)

    return docs.mapInArrow(run, COUNTS).groupBy("bucket").applyInPandas(add, COUNTS)


def _by_bucket(df: DataFrame, label: str) -> DataFrame:
    """``df`` written by ``bucket`` below ``spark.checkpoint.dir``: what is grouped by bucket later comes to it, not it to them."""
    spark = configure(df.sparkSession)
    name = f"tidemark_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket").option("path", shared_dir(spark, label)).saveAsTable(name)
    return spark.table(name)


def _sums(rows: DataFrame) -> np.ndarray:
    """The sum of the arrays ``sums``, place by place."""
    got = rows.filter("sums IS NOT NULL").select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(max((r["i"] for r in got), default=-1) + 1)
    for r in got:
        out[r["i"]] = r["x"]
    return out


def _corpus(counts: DataFrame) -> Model:
    """Sums over all buckets: tokens, known words, customers per ending, discounts, and the totals of one table per dish."""
    def run(frames):
        for f in frames:
            for row in f.to_dict("records"):
                words, contexts, pair, n = _read_counts(row)
                keys, customers = np.unique(words[pair >> np.uint64(32)] | contexts[pair & np.uint64(2**32 - 1)] & np.uint64(127), return_counts=True)
                ending = (keys & np.uint64(127)).astype(np.int64)
                _, dishes = np.unique(keys >> np.uint64(7), return_counts=True)
                few = [x for level in (n, customers, dishes) for x in ((level == 1).sum(), (level == 2).sum())]
                often = np.bincount((4 * np.log2(n[n > 1])).astype(np.int64), minlength=256)
                yield pd.DataFrame({"sums": [np.concatenate([[n.sum(), len(words)], few, np.bincount(ending, customers, CONTEXTS), np.bincount(ending, minlength=CONTEXTS), often]).astype(float)]})

    total = _sums(counts.mapInPandas(run, "sums array<double>"))
    total = total if len(total) else np.zeros(8 + 2 * CONTEXTS + 256)
    # The discount from how many dishes were taken once and twice, as in Kneser-Ney smoothing.
    discounts = [min(max(a / (a + 2 * b), 0.1), 0.95) if a else 0.5 for a, b in total[2:8].reshape(3, 2)]
    customers, tables, often = np.split(total[8:], [CONTEXTS, 2 * CONTEXTS])
    enough = int((np.cumsum(often[::-1]) <= FREQUENT).sum())  # classes of counts, a quarter of an octave each
    return Model(int(total[0]), int(total[1]), customers, discounts[1], discounts[2], [Totals(tables, float(tables.sum()), float(total[1]), customers)],
                 word_discount=discounts[0], least=max(2, int(np.ceil(2 ** ((256 - enough) / 4)))))


def _to_shards(number: int, sweep: int, shards: int, contexts: np.ndarray, **columns: np.ndarray) -> list[dict]:
    """Rows for the ranges of contexts: sorted contexts with numbers of each."""
    shard = contexts * np.uint64(shards) >> np.uint64(CONTEXT_BITS)
    cuts = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(shard)]])
    return [{"shard": int(shard[a]), "bucket": number, "sweep": sweep, "contexts": _pack_sorted(contexts[a:b])} | {k: pack_numbers(v[a:b]) for k, v in columns.items()}
            for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def _contexts(counts: DataFrame, shards: int) -> DataFrame:
    """By shard and bucket (``SHARD``): all contexts, times seen, pairs seen once, pairs seen more often."""
    def run(frames):
        for f in frames:
            for row in f.to_dict("records"):
                _, contexts, pair, n = _read_counts(row)
                of = (pair & np.uint64(2**32 - 1)).astype(np.int64)
                seen, ones, tables = (np.bincount(of, x, len(contexts)) for x in (n, n == 1, n > 1))
                yield _frame(_to_shards(row["bucket"], 0, shards, contexts, seen=seen, ones=ones, tables=tables), SHARD)

    return counts.mapInPandas(run, SHARD)


def _add_up(rows: DataFrame) -> DataFrame:
    """The totals per context, sent to the buckets that have pairs of it seen more than once (``WIRE``)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        contexts = [_unpack_sorted(x) for x in pdf["contexts"]]
        every, at = np.unique(np.concatenate(contexts), return_inverse=True)
        parts = np.split(at, np.cumsum([len(x) for x in contexts])[:-1])
        first = pdf["sweep"].iloc[0] == 0
        total = {k: np.bincount(at, np.concatenate([unpack_numbers(x) for x in pdf[c]]), len(every))
                 for k, c in ([(SEEN, "seen"), (ONES, "ones"), (0, "tables")] if first else [(int(pdf["sweep"].iloc[0]), "tables")])}
        out = []
        for bucket, tables, mine in zip(pdf["bucket"], pdf["tables"], parts):
            mine = mine[unpack_numbers(tables) > 0]
            if len(mine):
                out += [{"bucket": bucket, "batch": 0, "kind": k, "shard": pdf["shard"].iloc[0], "flags": pack_numbers(t[mine])} for k, t in total.items()]
        return _frame(out, WIRE)

    return rows.groupBy("shard").applyInPandas(run, WIRE)


def _all_totals(rows: DataFrame) -> DataFrame:
    """Times seen and tables in each sample of every context, sent to the buckets that name it (``WIRE``)."""
    kept = range(BURN_IN + 1, SWEEPS + 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[pdf["sweep"] == 0]
        contexts = [_unpack_sorted(x) for x in first["contexts"]]
        every, at = np.unique(np.concatenate(contexts), return_inverse=True)
        seen, ones = (np.bincount(at, np.concatenate([unpack_numbers(x) for x in first[c]]), len(every)) for c in ("seen", "ones"))
        total = np.stack([seen, *[ones] * len(kept)])
        for sweep, c, tables in zip(pdf["sweep"], pdf["contexts"], pdf["tables"]):
            if sweep:
                total[sweep - BURN_IN, np.searchsorted(every, _unpack_sorted(c))] += unpack_numbers(tables)
        parts = np.split(at, np.cumsum([len(x) for x in contexts])[:-1])
        return _frame([{"bucket": b, "batch": 0, "kind": ALL, "shard": pdf["shard"].iloc[0], "flags": pack_numbers(total[:, mine].ravel())} for b, mine in zip(first["bucket"], parts)], WIRE)

    return rows.groupBy("shard").applyInPandas(run, WIRE)


def _with(counts: DataFrame, rows: DataFrame, run, ddl: str) -> DataFrame:
    return counts.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInPandas(run, ddl)


def _sweep(counts: DataFrame, told: DataFrame, model: Model, shards: int) -> DataFrame:
    """One more sweep over all restaurants (``SHARD``): tables of contexts, and the sums of the endings and the root."""
    number = len(model.totals)

    def run(mine: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        b = Words(mine.iloc[0], model).told(rows)
        for n in range(1, number + 1):
            b.sweep(n)
        out = _to_shards(b.number, number, shards, b.contexts[b.asked], tables=b.per_context(b.many, b.tables)[b.asked])
        tables, seats = (np.bincount(b.ends.context, x, CONTEXTS) for x in (b.ends.tables, b.ends.counts))
        return _frame([*out, {"shard": -1, "bucket": b.number, "sweep": number, "sums": np.concatenate([tables, seats, [b.ends.parent_tables.sum()]])}], SHARD)

    return _with(counts, told, run, SHARD)


def train(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame, Model]:
    """The counts of the texts that are not held out (columns ``did, th, held, text``), the totals of contexts in every
    sweep for the buckets' own seating, the totals of all contexts in the samples, and the model sampled over them."""
    counts = _by_bucket(count_tokens(docs, buckets), "lm-counts")
    model = _corpus(counts)
    contexts = table(_contexts(counts, buckets), "lm-contexts")
    told, changed = [table(_add_up(contexts), "lm-totals")], [contexts]
    for number in range(1, SWEEPS + 1):
        swept = table(_sweep(counts, reduce(DataFrame.unionByName, told), model, buckets), "lm-sweep")
        total = _sums(swept)
        total = total if len(total) else np.zeros(2 * CONTEXTS + 1)
        model.totals.append(Totals(total[:CONTEXTS], float(total[:CONTEXTS].sum()), float(total[-1]), total[CONTEXTS:-1]))
        told.append(table(_add_up(swept.filter("shard >= 0")), "lm-totals"))
        if number > BURN_IN:
            changed.append(swept.filter("shard >= 0"))
    return counts, reduce(DataFrame.unionByName, told), _all_totals(reduce(DataFrame.unionByName, changed)), model


def _frequent(counts: DataFrame, told: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """The commonest pairs, ``FREQUENT`` at most: sorted keys, words, contexts, times the word was seen, log10 probability (8 MB)."""
    def run(mine: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        b = Words(mine.iloc[0], model).told(rows)
        often = np.nonzero(b.n >= model.least)[0]
        if not len(often):
            return pd.DataFrame({"words": [], "contexts": [], "seen": [], "logp": []})
        b.sample()
        word, at = (b.pair[often] >> np.uint64(32)).astype(np.int64), np.searchsorted(b.asked, b.context[often])
        words, contexts, seen = b.words[word], b.contexts[b.context[often]], b.ends.seen[word]
        logp = b.pair_scores(often, b.totals[SEEN][at], [b.total(n)[at] for n in range(BURN_IN + 1, len(model.totals))])
        return pd.DataFrame([[x.tobytes() for x in (words, contexts, seen, logp)]], columns=["words", "contexts", "seen", "logp"])

    got = _with(counts, told, run, "words binary, contexts binary, seen binary, logp binary").collect()
    words, contexts, seen, logp = (np.frombuffer(b"".join(r[c] for r in got), t) for c, t in (("words", np.uint64), ("contexts", np.uint64), ("seen", float), ("logp", float)))
    key = _key(words, contexts)
    order = np.argsort(key)
    return key[order], words[order], contexts[order], seen[order], logp[order]


def _key(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return words ^ contexts * np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(doc_id, th, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)`` per row of ``docs``.

    Tokens are the lower-cased words of a text and one end. The model learns from documents whose crc32(doc_id as
    text) mod 5 is not 1. ``score`` is the log10 probability of the tokens under the average of the kept Gibbs
    samples; ``base_score`` uses smoothed frequencies of single tokens. Frequent pairs of words are scored where they
    stand; each other token is looked up in its word's bucket, and the sums per document go back to the batch.

    A null or empty text is one token, the end. A null doc_id is in the training part. Repeated rows count and score
    one by one; extra columns are not read; an empty table gives no rows, and without training texts every token is
    unknown with equal probability. The rows of ``docs`` must be the same whenever they are computed (a file or a
    checkpoint).
    """
    buckets = buckets or buckets_for(word_total(docs), BUCKET_TOKENS)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *row_key(), F.col("text").cast("string").alias("text")).select("did", "th", held_out().alias("held"), "text")
    counts, told, totals, model = train(keyed, buckets)
    shared = docs.sparkSession.sparkContext.broadcast((model, *_frequent(counts, told, model)))
    # Without any training token there are no samples to look into.
    floor, n, v = 0.5, model.tokens, model.known

    def base(seen: np.ndarray) -> np.ndarray:
        return np.log10((seen + floor) / (n + floor * (v + 1)))

    def sums(doc, size, known, base, logp):
        return np.stack([np.bincount(doc, x, size) for x in (known, base, logp)])

    def ask(parts):
        _, keys, words, contexts, times, logp = shared.value
        for number, (dids, ths, _, sizes, word, context, doc) in enumerate(_codes(parts)):
            name = batch_name(number, dids, ths)
            at = np.minimum(np.searchsorted(keys, _key(word, context)), max(0, len(keys) - 1))
            here = (words[at] == word) & (contexts[at] == context) if len(keys) else np.zeros(len(word), bool)
            i = at[here]
            own = sums(doc[here], len(dids), times[i] > 0, base(times)[i], logp[i])
            doc, word, context = doc[~here], word[~here], context[~here]
            rows = [{"bucket": -1 - name % buckets, "batch": name, "kind": ASKED, "docs": np.concatenate([dids, ths, sizes]).tobytes(), "flags": own.tobytes()}]
            for bucket, j in _dealt(word, buckets):
                (w, which), (c, of) = np.unique(word[j], return_inverse=True), np.unique(context[j], return_inverse=True)
                rows.append({"bucket": bucket, "batch": name, "kind": ASKED, "places": pack_gaps(doc[j]), "words": _pack_sorted(w >> np.uint64(7)),
                             "contexts": _pack_sorted(c), "pairs": pack_numbers(which), "flags": pack_numbers(of)})
            yield _wire(rows)

    def answer(mine: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows[rows["kind"] == ASKED]
        if not len(mine):
            return asked[["batch", "docs", "places", "flags"]]
        every = [unpack_numbers(x) for x in rows[rows["kind"] == ALL].sort_values("shard")["flags"]]
        seen, *tables = np.concatenate([x.reshape(1 + SWEEPS - BURN_IN, -1) for x in every], axis=1).astype(np.float64)
        b = Words(mine.iloc[0], shared.value[0]).told(rows).sample().prepared(seen, tables)
        out = []
        for name, places, w, c, which, of in zip(*(asked[x] for x in ("batch", "places", "words", "contexts", "pairs", "flags"))):
            doc = unpack_gaps(places)  # rising
            new = np.diff(doc, prepend=-1) > 0
            docs_, doc = doc[new], np.cumsum(new) - 1
            which, of = unpack_numbers(which).astype(np.int64), unpack_numbers(of).astype(np.int64)
            times, logp = b.score(_unpack_sorted(w) << np.uint64(7), _unpack_sorted(c), which, of)
            out.append((int(name), None, pack_gaps(docs_), sums(doc, len(docs_), (times > 0)[which], base(times)[which], logp).tobytes()))
        return pd.DataFrame(out, columns=["batch", "docs", "places", "flags"])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["docs"].notna()]
        if len(own) != 1:
            raise RuntimeError("a batch of documents was made anew with other rows; read them from a file or checkpoint")
        dids, ths, sizes = np.frombuffer(own["docs"].iloc[0], np.int64).reshape(3, -1)
        total = np.frombuffer(own["flags"].iloc[0], np.float64).reshape(3, -1).copy()
        for places, flags in zip(pdf["places"], pdf["flags"]):
            if places is not None:
                total[:, unpack_gaps(places)] += np.frombuffer(flags, np.float64).reshape(3, -1)
        return pd.DataFrame({"did": dids, "th": ths, "n_tokens": sizes, "n_known": total[0].astype(np.int64), "base_score": total[1], "score": total[2]})

    asked = keyed.mapInArrow(ask, WIRE)
    answers = _with(counts, reduce(DataFrame.unionByName, [asked, told, totals]), answer, "batch bigint, docs binary, places binary, flags binary")
    scored = answers.groupBy("batch").applyInPandas(gather, "did bigint, th bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    out = scored.withColumn("doc_id", F.when(F.col("did") < 2**63 - 1, F.col("did")))
    return out.select("doc_id", "th", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
