"""Collocations by Toivonen's method: a sample proposes phrases, full passes count them and their negative border exactly.

A phrase of k words can only be frequent if both phrases of k - 1 words inside it are. The sample gives a set of phrases
that are probably frequent. The negative border are the phrases outside the set of which all parts are inside. One pass
over all texts counts both. A border phrase that turns out frequent was missed by the sample; the set then grows by the
missed phrases, and another pass counts what this adds to the border. That pass takes what it newly reaches as frequent
and goes on from there, so it closes the border at once. Every frequent phrase has then been counted, whatever the
sample was.

The set itself grows with the corpus, so no task holds it. Tasks ask a bitmap of fixed size instead: a phrase that
passes by chance is only counted in vain. The texts are split once, into a table of word codes of 32 bits, which the
counting passes read. Counts by code can only be too high, so they decide what to look at; the counts that are returned
are made per phrase text in the last pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .shared import buckets_for, pack_numbers, table, texts, unpack_numbers

# Lower-cases A-Z, ends a piece at punctuation and line ends, and makes a tab a space.
CLEAN = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
TOKEN = re.compile(rb"\n|[^ \n]+")
GAP = re.compile(rb"[ \n]")
MIX = np.uint64(0x9E3779B97F4A7C15)
LENGTH_BITS = 7  # the low bits of a phrase's key hold its number of words
WHOLE = 61  # bits of a key at most
SPARE = 13  # bits of a key beyond those that number all words: one key in 2^13 shares its place with another

CODES = 500_000  # codes that a task counts at a time
ROW = 100_000  # codes in a row of the table of codes
TOKENS = 250_000  # tokens of text that a task holds at a time
PART = 1_000_000  # bytes of a text that are split at a time
KNOWN = 150_000  # words whose hashes a task remembers
KEYS = 5_000_000  # keys that a task holds before they are counted and sent
BUCKET_WORDS = 2_000_000  # words of the corpus per range of keys
BITS = 27  # the bitmap has 2^27 bits: 16 MB, whatever the size of the corpus
SAMPLE = 8  # one document in so many proposes phrases


def _parts(text: bytes) -> Iterator[bytes]:
    """A text cut between words into parts of bounded size."""
    at = 0
    while len(text) - at > PART and (gap := GAP.search(text, at + PART)):
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


class Words(dict):
    """Word -> 64-bit hash, worked out once per word; 0 is the end of a piece. Emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = 0 if word == b"\n" else max(xxhash.xxh3_64_intdigest(word), 1)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _codes(hashes: np.ndarray) -> np.ndarray:
    """32 bits per word; 0 remains the end of a piece."""
    return np.where(hashes == 0, 0, np.maximum(hashes >> np.uint64(32), 1)).astype(np.uint32)


def _texts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, bytes]]:
    """The values of ``names`` and part of a text after part of a text, a few rows of a batch at a time."""
    for b in batches:
        for at in range(0, b.num_rows, 200):
            few = b.slice(at, 200)
            for kind, text in zip(zip(*(few.column(x).to_pylist() for x in names)), texts(few)):
                for part in _parts(text.translate(CLEAN) + b"\n"):
                    yield kind, part


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 1))


class Phrases:
    """All phrases of consecutive codes, level by level. ``fresh`` marks the codes that were not counted before.

    A key keeps the top ``width`` bits of a phrase's hash, as the others would only be carried about.
    """

    def __init__(self, codes: np.ndarray, seeds: np.ndarray | np.uint64, fresh: np.ndarray, width: int):
        self.words, self.fresh = codes > 0, fresh
        self.top = np.uint64((2**64 - 2 ** (64 - width)) & ~LENGTH_BITS)
        x = (codes + seeds) * MIX
        self.hash = (x ^ (x >> np.uint64(32))) * MIX

    def levels(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(k, keys, new)`` for k from 1: per start the key of k words, and whether the last one is fresh."""
        h = self.hash
        for k in range(1, longest + 1):
            if k > 1:
                h = h[: max(0, len(self.hash) - k + 1)] * MIX + self.hash[k - 1 :]
            yield k, (h & self.top) | np.uint64(k), self.fresh[k - 1 :]


class Bitmap:
    """Whether a key is in a set, by its top bits (no more than any key keeps): never wrong for a member."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, np.uint64(64 - int(np.log2(len(bits) * 8)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0

    def among(self, mask: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The places of ``mask`` whose keys are members."""
        out, at = np.zeros_like(mask), np.nonzero(mask)[0]
        out[at] = self.has(keys[at])
        return out


def bitmap(keys: DataFrame, bits: int = BITS) -> Bitmap:
    """The bitmap of a column ``key``, put together by Spark in pieces of 4 KB; 2^bits bits reach the driver."""
    place = F.shiftrightunsigned("key", 64 - bits)
    pieces = keys.groupBy(F.expr(f"shiftrightunsigned(key, {64 - bits}) div 32768").alias("piece")).agg(F.bitmap_construct_agg(place % 32768).alias("bits")).collect()
    out = np.zeros(2**bits // 8, np.uint8)
    for r in pieces:
        out[r["piece"] * 4096 : (r["piece"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return Bitmap(out)


def encoded(docs: DataFrame, longest: int) -> DataFrame:
    """``(lang, sample, old, words, codes)``: the texts as word codes, many texts of a language (in the sample or not) to a row.

    A row starts with the last codes of the row before (``old`` of them), so that no phrase is lost between two.
    """
    names, keep = ["lang", "sample", "old", "words", "codes"], longest - 1
    kinds = [pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        known, held, old = Words(), {}, {}

        def row(kind):
            codes = np.concatenate(held[kind])
            n, held[kind], old[kind] = old[kind], [codes[-keep:]], min(keep, len(codes))
            return *kind, n, int((codes[n:] > 0).sum()), codes.tobytes()

        def frame(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        size, total = {}, 0
        for kind, part in _texts(batches, ["lang", "sample"]):
            codes = _codes(known.of(TOKEN.findall(part)))
            held.setdefault(kind, []).append(codes)
            old.setdefault(kind, 0)
            size[kind] = size.get(kind, 0) + len(codes)
            total += len(codes)
            if size[kind] >= ROW:
                total -= size.pop(kind)
                yield frame([row(kind)])
            elif total >= 10 * ROW:  # many languages with a little text each
                yield frame([row(x) for x in size])
                size, total = {}, 0
        if size:
            yield frame([row(x) for x in size])

    return docs.select("lang", "sample", "text").mapInArrow(run, "lang string, sample boolean, old int, words bigint, codes binary")


def _stretches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Phrases]:
    """The codes of several rows of a language, with an end between two rows."""
    held, size = {}, {}

    def stretch(lang):
        rows = held.pop(lang)
        del size[lang]
        codes = np.concatenate([x for _, c in rows for x in (c, np.zeros(1, np.uint32))])
        fresh, at = np.ones(len(codes), bool), 0
        for n, c in rows:
            fresh[at : at + n] = False
            at += len(c) + 1
        return Phrases(codes, _seed(lang), fresh, width)

    for b in batches:
        for lang, n, codes in zip(b.column("lang").to_pylist(), b.column("old").to_pylist(), b.column("codes")):
            c = np.frombuffer(codes.as_py(), np.uint32)
            held.setdefault(lang, []).append((n, c))
            size[lang] = size.get(lang, 0) + len(c)
            if size[lang] >= CODES or sum(size.values()) >= 2 * CODES:
                yield stretch(max(size, key=size.get))
    for lang in list(held):
        yield stretch(lang)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Jobs inside send rows to the tasks' Python in small batches, as texts and rows of codes are large."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


PACKED = "bucket int, keys binary, n binary"


def _ranges(keys: list[np.ndarray], width: int, buckets: int) -> pa.RecordBatch:
    """Keys with their counts, by range of keys: sorted, as their gaps, so that a key takes about three bytes."""
    u, n = np.unique(np.concatenate(keys), return_counts=True)
    short = u >> np.uint64(64 - width) << np.uint64(3) | u & np.uint64(7)
    bucket = (u >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
    cuts = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1, [len(u)]])
    rows = [(int(bucket[a]), pack_numbers(np.diff(short[a:b], prepend=np.uint64(0))), pack_numbers(n[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["bucket", "keys", "n"])


def _counted(codes: DataFrame, found, width: int, least: int, buckets: int) -> DataFrame:
    """``(key, n)`` of the keys that ``found`` gives ``least`` times or more."""
    def run(batches):
        held, size = [], 0
        for keys in found(batches):
            held.append(keys)
            size += len(keys)
            if size >= KEYS:
                yield _ranges(held, width, buckets)
                held, size = [], 0
        if size:
            yield _ranges(held, width, buckets)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        short = np.concatenate([np.cumsum(unpack_numbers(x), dtype=np.uint64) for x in pdf["keys"]])
        order = np.argsort(short)
        short, n = short[order], np.concatenate([unpack_numbers(x) for x in pdf["n"]])[order]
        starts = np.nonzero(np.diff(short, prepend=~short[:1]))[0]
        total = np.add.reduceat(n, starts)
        short, total = short[starts][total >= least], total[total >= least]
        keys = short >> np.uint64(3) << np.uint64(64 - width) | short & np.uint64(7)
        return pd.DataFrame({"key": keys.view(np.int64), "n": total.astype(np.int64)})

    return codes.select("lang", "old", "codes").mapInArrow(run, PACKED).groupBy("bucket").applyInPandas(add, "key bigint, n bigint")


def word_counts(codes: DataFrame, width: int, least: int = 1, buckets: int = 32) -> DataFrame:
    """``(key, n)`` of the words of every language that occur ``least`` times."""
    def run(batches):
        for p in _stretches(batches, width):
            _, keys, new = next(p.levels(1))
            yield keys[p.words & new]

    return _counted(codes, run, width, least, buckets)


def phrase_counts(codes: DataFrame, width: int, members: Bitmap, first: int, last: int, assume: int = 99, before: Bitmap | None = None,
                  least: int = 1, buckets: int = 32) -> DataFrame:
    """``(key, n)`` of the phrases of ``first`` to ``last`` words that occur ``least`` times and whose two shorter parts are members.

    With ``before``, only phrases that were not counted under that earlier set. From ``assume`` words on, a phrase
    that is counted here is a member for the longer ones around it.
    """
    shared = codes.sparkSession.sparkContext.broadcast((members, before))  # two bitmaps of fixed size

    def run(batches):
        now, then = shared.value
        for p in _stretches(batches, width):
            inside = known = None
            for k, keys, new in p.levels(last):
                if k == 1:
                    inside, known = now.among(p.words, keys), then.among(p.words, keys) if then else None
                    continue
                reach = inside[:-1] & inside[1:]
                old = known[:-1] & known[1:] if then else np.zeros_like(reach)
                added = reach & ~old
                if k >= first and (counted := added & new).any():
                    yield keys[counted]
                inside = now.among(reach, keys) | (added if k >= assume else False)
                known = then.among(old, keys) if then else None

    return _counted(codes, run, width, least, buckets)


def phrase_texts(docs: DataFrame, members: Bitmap, longest: int) -> DataFrame:
    """``(lang, phrase, n)``: the exact counts, by their text, of all phrases that are members with all their parts."""
    shared = docs.sparkSession.sparkContext.broadcast(members)
    names = ["lang", "phrase", "n"]

    def run(batches):
        known = Words()
        for tokens, owner, langs, old in _token_runs(batches, longest):
            hashes, seeds = known.of(tokens), np.array([_seed(x) for x in langs], np.uint64)[owner]
            fresh, inside = np.arange(len(tokens)) >= old, None
            by_code, by_word = (Phrases(x, seeds, fresh, WHOLE).levels(longest) for x in (_codes(hashes), hashes))
            for (k, keys, new), (_, names_of, _) in zip(by_code, by_word):  # members are known by code, phrases told apart by whole hashes
                inside = shared.value.among(hashes > 0 if k == 1 else inside[:-1] & inside[1:], keys)
                at = np.nonzero(inside & new)[0]
                if not len(at):
                    continue
                coded = pa.array(names_of[at]).dictionary_encode()
                number = coded.indices.to_numpy()
                first = np.empty(len(coded.dictionary), np.int64)
                first[number[::-1]] = at[::-1]
                phrases = [b" ".join(tokens[i : i + k]) for i in first.tolist()]
                lang = pa.DictionaryArray.from_arrays(pa.array(owner[first].astype(np.int32)), pa.array(langs, pa.string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, pa.array(phrases, pa.binary()), pa.array(np.bincount(number))], names)

    found = docs.select("lang", "text").mapInArrow(run, "lang string, phrase binary, n bigint")
    return found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))


def _token_runs(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[list[bytes], np.ndarray, list[str], int]]:
    """``(tokens, number of the language per token, languages, old)``: consecutive tokens, the first ``old`` from the run before."""
    tokens, runs, langs, old = [], [], {}, 0

    def owners():
        return np.repeat(np.array([x for x, _ in runs], np.int64), [n for _, n in runs])

    for (lang,), part in _texts(batches, ["lang"]):
        found = TOKEN.findall(part)
        tokens += found
        runs.append((langs.setdefault(lang, len(langs)), len(found)))
        if len(tokens) >= TOKENS:
            yield tokens, (owner := owners()), list(langs), old
            tokens = tokens[-(longest - 1) :]
            names = [list(langs)[i] for i in owner[-len(tokens) :]]
            langs = {x: i for i, x in enumerate(dict.fromkeys(names))}
            runs, old = [(langs[x], 1) for x in names], len(tokens)
    if len(tokens) > old:
        yield tokens, owners(), list(langs), old


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, sample: int = SAMPLE, slack: float = 0.25, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, n)`` of all phrases of 1 to ``longest`` words that occur ``least`` times in a language, and ``(lang, words)``.

    One document in ``sample``, by a hash of id and text, proposes the phrases that it holds ``slack`` times as often
    as their share of ``least`` would be (once at least). A smaller slack makes misses rarer and the border larger;
    the result is the same.
    """
    assert 2 <= longest <= 7, "a phrase's length has three bits"
    narrow = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.make_valid_utf8(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
        (F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0).alias("sample"),
    )
    with small_batches(docs.sparkSession):
        return _mined(narrow, least, longest, max(1, int(least / sample * slack)), bits)


def _mined(narrow: DataFrame, least: int, longest: int, enough: int, bits: int) -> tuple[DataFrame, DataFrame]:
    spark = narrow.sparkSession
    path = shared_dir(spark, "codes")
    encoded(narrow, longest).write.option("compression", "zstd").parquet(path)
    codes = spark.read.parquet(path)
    totals = codes.groupBy("lang").agg(F.sum("words").alias("words"))
    n = codes.agg(F.sum("words").alias("n")).first()["n"] or 0
    width, buckets = min(WHOLE, max(bits, n.bit_length() + SPARE)), buckets_for(n, BUCKET_WORDS)
    counts = lambda rows, most, *how, **more: phrase_counts(rows, width, *how, least=most, buckets=buckets, **more).select("key")
    singles = table(word_counts(codes, width, least, buckets).select("key"), "words")

    # The sample: pairs of frequent words, then longer phrases of frequent pairs.
    some = codes.filter("sample")
    proposed = singles.union(table(counts(some, enough, bitmap(singles, bits), 2, 2), "proposed"))
    if longest > 2:
        proposed = proposed.union(table(counts(some, enough, bitmap(proposed, bits), 3, longest, assume=3), "proposed"))

    # The proposed phrases and their border, then all that the missed ones add to the border.
    members = bitmap(proposed, bits)
    counted = table(counts(codes, least, members, 2, longest), "counted")
    missed = table(counted.filter(f"key & {LENGTH_BITS} < {longest}").join(proposed, "key", "left_anti"), "missed")
    found = singles.union(counted)
    if missed.take(1):
        grown = bitmap(proposed.union(missed), bits)
        found = found.union(table(counts(codes, least, grown, 2, longest, assume=2, before=members), "counted"))
    exact = phrase_texts(narrow, bitmap(found, bits), longest).filter(F.col("n") >= least)
    return table(exact, "phrases"), totals


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, **mining) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of 2 to ``longest`` words of each language.

    ``docs`` has ``doc_id``, ``text`` and ``lang``. Words are lower-cased in A-Z; punctuation and line ends separate
    pieces, spaces and tabs words; a phrase lies within a piece. ``a`` counts its places, overlaps included, ``n`` all
    words of the language. A cut after the first k words gives ``l`` and ``r``, the counts of both sides, and a score
    of floor(1000 a n / (l r)) in exact decimals; the lowest cut counts, of equal ones the first. A phrase inside a
    longer one that is as frequent is dropped. Ranks go by score, then ``a``, then the phrase's bytes.

    Null and empty texts have no words; a null language is ``und``. Malformed UTF-8 is replaced by U+FFFD. Repeated
    rows and equal ids count as often as they stand there. Very long texts are read in parts. Other columns may have
    any name. Empty tables, and languages without a frequent phrase, give no rows.
    """
    phrases, totals = frequent_phrases(docs, least, longest, **mining)
    split = phrases.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w"))
    candidates = split.filter("k >= 2").withColumnRenamed("n", "a")

    # The counts of both sides of every cut: each side is frequent itself.
    cuts = candidates.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("left"), F.expr("array_join(slice(w, cut + 1, k - cut), ' ')").alias("right"))
    sides = cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    sides = sides.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]).join(totals.withColumnRenamed("words", "n"), "lang")
    score = F.expr("(cast(1000 AS decimal(4,0)) * cast(a AS decimal(15,0)) * cast(n AS decimal(18,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))")
    best = sides.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("b")).select("lang", "phrase", "b.*")

    # The greatest count of a longer phrase around each phrase.
    inner = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    around = candidates.filter("k > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    kept = best.join(around, ["lang", "phrase"], "left").filter("outer IS NULL OR outer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
