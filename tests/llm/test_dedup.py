"""SimHash groups, repeated windows, contamination and licences against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, licenses, simhash, substrings
from tidemark.llm.components import components
from tidemark.llm.fm_index import FMIndex, suffix_array

SPLIT = r"[^\x20\x09-\x0D]+"
ALNUM = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups_of(prints, most=3):
    """Smallest reachable fingerprint of each, by comparing all pairs."""
    u = np.unique(np.array(prints, np.uint64))
    parent = list(range(len(u)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(u)):
        for j in np.nonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= most)[0]:
            a, b = sorted((find(i), find(int(i + 1 + j))))
            parent[b] = a
    return {int(x): int(u[find(i)]) for i, x in enumerate(u)}


def plain_print(text):
    w = re.findall(SPLIT, lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("direct", [2048, 4])
def test_simhash_groups(spark, small, direct):
    docs = small("documents")
    got = simhash.simhash_groups(docs, direct=direct).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{plain_print(t):016x}" for d, t in text.items()}
    root = groups_of([int(r.fingerprint, 16) for r in got])
    least = {}
    for r in got:
        g = root[int(r.fingerprint, 16)]
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert all(r.component_id == least[root[int(r.fingerprint, 16)]] for r in got)


def test_simhash_large_cluster(spark):
    """A cluster that is cut by the second level of signatures, chains across it, and bits in both halves."""
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    prints = {int(centre)}
    for _ in range(600):
        x = int(rng.choice(np.array(sorted(prints), np.uint64)))
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "fp bigint")
    for direct in (8, 2048):
        found = components(simhash.near_edges(df, 3, direct)).collect()
        mine = {p: p for p, in signed} | {r.node: r.root for r in found}
        want = groups_of(sorted(prints))
        as_sets = lambda m: sorted(sorted(k for k in m if m[k] == g) for g in set(m.values()))
        assert as_sets(mine) == as_sets({int(np.uint64(k).view(np.int64)): int(np.uint64(v).view(np.int64)) for k, v in want.items()})


def test_signatures_are_not_broadcast(spark):
    """The 64 signatures of each fingerprint are many more rows than the planner thinks, also where the table is small."""
    found = simhash.near_edges(spark.range(500).select(F.xxhash64("id").alias("fp")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "REPARTITION_BY_NUM" in plan  # else one task may make all signatures


def test_pipeline_broadcasts_no_rows_of_exploded_tables(spark, small, monkeypatch):
    """Signatures in near-dedup, copies of documents in the mix: the planner sizes both as the rows that they are made from."""
    plans, found = [], simhash.near_edges

    def spied(*args):
        edges = found(*args)
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return edges

    monkeypatch.setattr(simhash, "near_edges", spied)
    docs = small("documents")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    mixed = corpus_pipeline.source_mix(spark, docs, "")
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in (kept, mixed)]
    assert all("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p for p in plans[:1]) and all(re.search(r"SortMergeJoin \[__did#\d+L, __row#\d+L\]", p) for p in plans[1:])
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= ids and mixed.count() > len(ids)


def test_dense_groups_equal_direct():
    rng = np.random.default_rng(2)
    p = np.unique(rng.integers(0, 2**14, 900, dtype=np.uint64) << np.uint64(7) | np.uint64(5) << np.uint64(40))
    for most in (1, 2, 3):
        assert (simhash._dense_groups(p, most) == simhash.near_groups(p, most)).all()


def test_simhash_edges(edges, nothing):
    got = simhash.simhash_groups(edges).collect()
    assert len(got) == edges.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "0" * 16
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert by[7].component_id == by[8].component_id == 7
    assert simhash.simhash_groups(nothing).count() == 0
    kept = simhash.one_per_group(edges)
    assert kept.columns == edges.columns and kept.filter("doc_id IN (1, 2, 3)").count() == 1 and kept.filter("doc_id = 8").count() == 0
    assert simhash.one_per_group(nothing).count() == 0


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {101: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_repeats(rows, window):
    """(did, text) in order -> (words, removed places)."""
    first, out = {}, []
    cut = [(d, re.findall(SPLIT, t or "")) for d, t in rows]
    for d, w in cut:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (d, i)), (d, i))
    for d, w in cut:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone.update(range(i, i + window))
        out.append((d, w, gone))
    return out


@pytest.mark.parametrize("batch", [1_500_000, 2_000])
def test_substring_dedup(edges, small, monkeypatch, batch):
    monkeypatch.setattr(substrings, "BATCH_WORDS", batch)
    for docs in (edges, small("documents")):
        rows = [(r.doc_id if r.doc_id is not None else 2**63 - 1, r.text) for r in docs.collect()]
        want = sorted((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()) for d, w, gone in brute_repeats(rows, 20))
        got = substrings.without_repeats(docs).select("did", "n_words", "n_removed", F.sha2("kept_text", 256).alias("s"), "spans").collect()
        assert sorted((r.did, r.n_words, r.n_removed, r.s) for r in got) == want
        assert all(r.n_removed == sum(s.stop - s.start for s in r.spans) for r in got)


def test_substring_dedup_of_malformed_text(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(40))
    spark.sql(f"SELECT id AS doc_id, concat('own', id, ' ', cast(X'FF' AS STRING), ' {words}') AS text FROM range(3)").write.parquet(str(tmp_path / "d"))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], bytes(r["b"])) for r in substrings.without_repeats(spark.read.parquet(str(tmp_path / "d"))).withColumn("b", F.col("kept_text").cast("binary")).collect()}
    assert got == {0: (42, 0, b"own0 \xff " + words.encode()), 1: (42, 41, b"own1"), 2: (42, 41, b"own2")}


def test_substring_dedup_empty_and_odd_window(nothing, edges):
    assert substrings.without_repeats(nothing).count() == 0
    rows = [(r.doc_id if r.doc_id is not None else 2**63 - 1, r.text) for r in edges.collect()]
    want = sorted((d, len(gone)) for d, _, gone in brute_repeats(rows, 7))
    assert sorted((r.did, r.n_removed) for r in substrings.without_repeats(edges, window=7, buckets=3).collect()) == want


def brute_contamination(docs, items, window=13):
    phrases = {}
    for i, t in items:
        w = re.findall(ALNUM, lower(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = re.findall(ALNUM, lower(t)), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k : k + n])) in phrases:
                    hit.update(range(k, k + n))
                    found |= phrases[p]
        out.append((d if d is not None else -1, len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("block", [32_000_000, 2_000])
def test_contamination(spark, edges, small, monkeypatch, block):
    own = [r.text for r in edges.filter("doc_id IN (7, 11, 17)").orderBy("doc_id").collect()]
    items = [(1, own[0]), (2, own[1][30:200]), (3, "of the"), (3, own[2][:40]), (4, None), (5, ""), (None, "two words"), (6, "東京")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", 500)
    got = decontaminate.contaminated(decontaminate.find_contamination(edges, bench, block_bytes=block)).collect()
    seen = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, sorted(r["items"])) for r in got)
    assert seen == brute_contamination([(r.doc_id, r.text) for r in edges.collect()], items)
    docs, bench = small("documents"), small("benchmark")
    got = decontaminate.contaminated(decontaminate.find_contamination(docs, bench, block_bytes=block)).collect()
    want = brute_contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in got) == want
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)


def test_contamination_of_nothing(spark, edges, nothing):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_contamination(edges, bench).filter("size(spans) > 0").count() == 0
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    assert decontaminate.clean(edges, bench).count() == edges.count()


def test_fm_index_against_scan():
    rng = np.random.default_rng(3)
    runs = [rng.integers(1, 5, n) for n in (1, 40, 40, 200, 3)] + [np.array([1, 2] * 50)]
    index = FMIndex([np.asarray(r, np.int64) for r in runs], 4)
    for n in (1, 2, 5):
        phrases = np.unique(np.concatenate([[r[i : i + n] for i in range(len(r) - n + 1)] or np.empty((0, n), int) for r in runs]), axis=0)
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = sorted(int(s + i) for s, r in zip(index.starts, runs) for i in range(len(r) - n + 1) if (r[i : i + n] == p).all())
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    text = rng.integers(0, 3, 100)
    assert suffix_array(text).tolist() == sorted(range(100), key=lambda i: text[i:].tolist())


def test_license_base_places(edges, small, spark):
    texts = ["The MIT License, and mit-license; MIT\nLICENSE", "general public license apache license", "licence mit", None, "",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
             "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions "
             "in binary form must reproduce the above copyright notice"]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    phrases = [(tuple(p.split()), label) for p, label in licenses.PHRASES.items()]
    for docs in (made, edges, small("documents")):
        want = []
        for r in docs.collect():
            w = re.findall(ALNUM, lower(r.text))
            at = sorted((i, label) for i in range(len(w)) for p, label in phrases if tuple(w[i : i + len(p)]) == p)
            want.append((str(r.doc_id), len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
        got = licenses.scan_licenses(docs).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == sorted(want, key=repr) or \
            sorted(map(repr, ((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(map(repr, want))
        assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    labels = {r.doc_id: r["labels"] for r in licenses.scan_licenses(made).collect()}
    assert labels[0] == "mit" and labels[1] == "apache,gpl" and labels[5] == "bsd" and labels[3] == ""


def test_short_wording_needs_the_name_of_the_licence(spark):
    texts = ["the single was released under the name X", "licensed under the BSD license", "released under the bridge, licensed under the counter", "released under the MIT terms",
             "licensed under the MIT", "licensed under CC BY 4.0", "licensed under a pseudonym",
             "This work is licensed under the BSD License, version 3", "This work is licensed under a 4.0 International License", "This work is licensed under the GNU General Public Licence, v3"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r["labels"], r.score) for r in licenses.scan_licenses(made).collect()}
    assert [got[i][0] for i in range(len(texts))] == ["", "", "", "", "", "cc", "", "", "", "gpl"]
    assert all(got[i][1] < 0.1 for i in (0, 1, 2, 6, 7, 8))


def test_prose_and_half_named_wording_have_no_label(spark):
    texts = ["the film was released under the mit press label", "licensed under cc by the council", "this work is licensed under a creative commons", "it was released under the MIT License"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r["labels"] for r in sorted(licenses.scan_licenses(made).collect())] == ["", "", "", "mit"]


@pytest.mark.parametrize("every", [5, 9, 14])
def test_replaced_words_break_no_chain(spark, every):
    """Every so many words are replaced; a dynamic program over document and template places says what a chain can cover."""
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)
    made = []
    for t, words in enumerate(scanner.words):
        if len(words) >= licenses.SHORT:
            made.append((t, [b"zzz" if i % every == every - 1 else w for i, w in enumerate(words)]))

    def possible(doc, template):
        best = 0
        ends = {}  # (document place, template place) -> words covered by chains of runs that end there
        run = {}
        for i in range(len(doc)):
            for j in range(len(template)):
                run[i, j] = run.get((i - 1, j - 1), 0) + 1 if doc[i] == template[j] else 0
                n = run[i, j]
                if n >= licenses.MATCH:
                    before = max((c for (a, b), c in ends.items() if b <= j - n and i - n - licenses.GAP <= a <= i - n), default=0)
                    ends[i, j] = before + n
                    best = max(best, before + n)
        return best / len(template)

    docs = spark.createDataFrame([(t, b"start " + b" ".join(w) + b" stop") for t, w in made], "doc_id bigint, text binary").withColumn("text", F.col("text").cast("string"))
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for t, words in made:
        share = max((c[3] for c in scanner.chains(words) if c[2] == scanner.labels[t]), default=0)
        assert share >= possible(words, scanner.words[t]) - 1e-9, scanner.labels[t]
        if share >= licenses.COVER:
            assert scanner.labels[t] in got[t]["labels"].split(",")


def test_suffix_automaton_matches_are_longest():
    rng = np.random.default_rng(4)
    word = lambda n: [b"%d" % x for x in rng.integers(0, 4, n)]
    templates = [word(n) for n in (5, 12, 30)]
    inside = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    automaton = licenses.SuffixAutomaton(templates)
    text = word(300)
    longest = [max((n for n in range(0, i + 1) if n == 0 or tuple(text[i - n : i]) in inside), default=0) for i in range(len(text) + 1)]
    want = [(i, longest[i]) for i in range(1, len(text) + 1) if longest[i] >= 3 and (i == len(text) or longest[i + 1] != longest[i] + 1)]
    got = list(automaton.matches(text, 3))
    assert [(i, n) for i, n, _ in got] == want
    for i, n, state in got:
        assert {(t, e) for t, w in enumerate(templates) for e in range(n, len(w) + 1) if w[e - n : e] == text[i - n : i]} == set(automaton.ends[state])
