"""Collocations against plain Python, with samples that miss phrases, and the chunked reading of texts."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))]


def plain_python(rows, least, longest=5, top=2000):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        for p in pieces(text):
            words[lang or "und"] += len(p)
            counts.update((lang or "und", tuple(p[i : i + k])) for k in range(1, longest + 1) for i in range(len(p) - k + 1))
    frequent = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    outer = Counter()
    for (lang, g), a in frequent.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                outer[lang, g[i : i + m]] = max(outer[lang, g[i : i + m]], a)
    out = {}
    for (lang, g), a in frequent.items():
        if outer[lang, g] >= a:
            continue
        score, cut = min((Fraction(1000 * a * words[lang], counts[lang, g[:k]] * counts[lang, g[k:]]) // 1, k) for k in range(1, len(g)))
        out.setdefault(lang, []).append((score, a, " ".join(g), counts[lang, g[:cut]], counts[lang, g[cut:]], words[lang]))
    return sorted(
        (lang, i, p, a, left, right, n, score)
        for lang, found in out.items()
        for i, (score, a, p, left, right, n) in enumerate(sorted(found, key=lambda x: (-x[0], -x[1], x[2].encode()))[:top], 1)
    )


def corpus(seed, n):
    r = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "x'y", "delta-e", "ñu", "東京", "the", "of", " odd"]
    fixed = ["the end of alpha beta", "x'y gamma delta-e", "of the of the of the of the", "beta beta beta beta"]
    out = []
    for i in range(n):
        t = "".join(r.choice(words if r.random() < 0.8 else fixed) + r.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\r\n", "\x0b", "  "]) for _ in range(r.randint(0, 60)))
        out.append((i % 50 - 1, t, r.choice(["en", "en", "en", "de", None, "und"])))
    return out + [(None, None, "en"), (3, "", None), (4, "! , .", "de"), (None, "alpha beta " * 3000, "fr"), (7, "alpha beta", "fr"), (7, "alpha beta", "fr")]


@pytest.mark.parametrize(("least", "mining"), [(12, {}), (12, {"sample": 2, "slack": 3.0, "bits": 20}), (5, {"sample": 40, "slack": 1.0, "bits": 18}), (200, {"sample": 1000})])
def test_against_plain_python(spark, least, mining):
    rows = corpus(least, 400)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = sorted(map(tuple, C.collocations(docs, least=least, top=25, **mining).collect()))
    assert got == plain_python([(lang, t) for _, t, lang in rows], least, top=25)
    assert got


def test_phrase_lengths(spark):
    rows = corpus(1, 200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for longest in (2, 3):
        assert sorted(map(tuple, C.collocations(docs, least=10, longest=longest).collect())) == plain_python([(lang, t) for _, t, lang in rows], 10, longest)


def test_edges(edges, nothing):
    rows = [(r["lang"], r["text"]) for r in edges.collect()]
    assert sorted(map(tuple, C.collocations(edges, least=20).collect())) == plain_python(rows, 20)
    assert C.collocations(nothing).collect() == []


def test_malformed_text(spark):
    docs = spark.sql("SELECT 1 AS doc_id, 'en' AS lang, concat('a ', cast(X'FF' AS STRING), ' b. ') AS text FROM range(30)")
    assert [tuple(r)[2:5] for r in C.collocations(docs, least=30).collect()] == [("a � b", 30, 30)]


def test_reading_in_parts_loses_and_repeats_nothing(monkeypatch, spark):
    rows = [(lang or "und", t or "") for _, t, lang in corpus(5, 120)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows]), pa.array([t for _, t in rows])], ["lang", "text"])

    def counts():
        total = Counter()
        for tokens, owner, langs, old in C._token_runs(iter([batch]), 5):
            for k in range(1, 6):
                grams = ((langs[owner[i]], tuple(tokens[i : i + k])) for i in range(max(0, old - k + 1), len(tokens) - k + 1))
                total.update(g for g in grams if b"\n" not in g[1])
        return total

    whole = counts()
    for chunk, part in ((1, 4_000_000), (7, 5), (100, 50), (4, 1)):
        monkeypatch.setattr(C, "TOKENS", chunk)
        monkeypatch.setattr(C, "PART", part)
        assert counts() == whole


def test_codes_in_parts(monkeypatch):
    rows = [(lang or "und", t or "") for _, t, lang in corpus(6, 120)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows]), pa.array([i % 3 == 0 for i in range(len(rows))]), pa.array([t for _, t in rows])], ["lang", "sample", "text"])

    class Docs:
        """Runs the function that a task gets over one batch."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return list(run(iter([batch])))

    def counts():
        total = Counter()
        for p in C._stretches(iter(C.encoded(Docs(), 5)), 61):
            inside = p.words
            for k, keys, new in p.levels(5):
                inside = p.words if k == 1 else inside[:-1] & p.words[k - 1 :]
                total.update(keys[inside & new].tolist())
        return total

    whole = counts()
    assert sum(n for key, n in whole.items() if key & 7 == 1) == sum(len(p) for _, t in rows for p in pieces(t))
    for row, codes, part in ((1, 1, 4_000_000), (7, 50, 5), (100, 2_000_000, 50), (3, 9, 1)):
        monkeypatch.setattr(C, "ROW", row)
        monkeypatch.setattr(C, "CODES", codes)
        monkeypatch.setattr(C, "PART", part)
        assert counts() == whole


def test_bitmap_holds_its_members(spark):
    r = np.random.default_rng(1)
    keys = r.integers(0, 2**64, 5000, dtype=np.uint64)
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key bigint")
    made = C.bitmap(df, bits=20)
    others = r.integers(0, 2**64, 5000, dtype=np.uint64)
    assert made.has(keys).all() and made.has(others).mean() < 0.02


def test_words_that_share_a_code_are_counted_apart(spark):
    seen = {}
    pair = next((seen[c], w) for i in range(2_000_000) if (c := xxhash.xxh3_64_intdigest(w := b"w%d" % i) >> 32) in seen or seen.setdefault(c, w) is None)
    a, b = (w.decode() for w in pair)
    text = f"{a} x. " * 20 + f"{b} x. " * 15 + f"{b} y. " * 9
    docs = spark.createDataFrame([(1, "en", text)], "doc_id bigint, lang string, text string")
    phrases, _ = C.frequent_phrases(docs, least=10)
    assert dict((r["phrase"], r["n"]) for r in phrases.collect()) == {a: 20, b: 24, "x": 35, f"{a} x": 20, f"{b} x": 15}


def test_counts_are_sent_packed(spark, tmp_path, monkeypatch):
    """Keys cross the shuffle in a few bytes each, in ranges whose number follows the corpus; counts stay exact."""
    monkeypatch.setattr(C, "KEYS", 3000)
    r = np.random.default_rng(2)
    codes = [np.append(r.zipf(1.3, 4000).clip(max=2**31).astype(np.uint32), np.uint32(0)) for _ in range(5)]
    path = str(tmp_path / "codes")
    spark.createDataFrame([("en", 0, c.tobytes()) for c in codes], "lang string, old int, codes binary").write.parquet(path)
    want = Counter(x for c in codes for x in next(C.Phrases(c, C._seed("en"), np.ones(len(c), bool), 40).levels(1))[1][c > 0].view(np.int64).tolist())
    for least, buckets in ((1, 1), (3, 7), (50, 1000)):
        got = {x.key: x.n for x in C.word_counts(spark.read.parquet(path), 40, least, buckets).collect()}
        assert got == {k: n for k, n in want.items() if n >= least}
    keys = r.integers(0, 2**40, 200_000).astype(np.uint64) << np.uint64(24) | np.uint64(2)
    assert C._ranges([keys], 40, 32).num_rows == 32
    assert sum(len(zlib.compress(x.as_py())) for c in ("keys", "n") for x in C._ranges([keys], 40, 32).column(c)) < 5 * len(keys)
