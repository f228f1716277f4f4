"""Near-duplicate groups against plain Python, through small, large and dense nodes."""

import random

import numpy as np
import pytest

from tidemark.llm import chosen_path as C
from tidemark.llm.queries import QUERIES
from tidemark.llm.shared import WordHash

WORDS = [a + b for a in "ab cd ef gh ij kl mn op qr st".split() for b in "a e i o u x y z".split()]


def shingle_set(text, size=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_python(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (a == b or find(i) != find(j)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def changed(r, words, share):
    out = list(words)
    for i in range(len(out)):
        if r.random() < share:
            out[i] = r.choice(WORDS)
    return out


def corpus(seed, plain=60, families=8, members=12):
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 120))) for _ in range(plain)]
    for f in range(families):
        base = [r.choice(WORDS) for _ in range(r.randint(30, 200))]
        for _ in range(members):
            texts.append(" ".join(changed(r, base, r.choice([0, 0.01, 0.02, 0.04, 0.06]))))
            if r.random() < 0.3:  # a chain away from the base
                base = changed(r, base, 0.03)
    line = "this very line is part of a great many texts that have nothing else in common "
    texts += [line * 2 + " ".join(r.choice(WORDS) for _ in range(40)) for _ in range(40)]
    texts += ["", None, " \t\n", "One", "one", "one two", "ONE  two", "one two three", "é É é", "é É é", texts[0].upper()]
    r.shuffle(texts)
    return list(enumerate(texts, 100)) + [(None, texts[3]), (None, "nothing like it anywhere"), (None, None), (5, texts[7]), (5, texts[7])]


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [500, 6, 2])
def test_against_plain_python(spark, limit):
    rows = corpus(limit)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(C.near_duplicates(docs, recall=0.9999999, limit=limit)) == plain_python(rows)


def test_dense_node_with_strays(spark):
    """A hundred near copies of which some only touch a few others: blocks, the shared set, and strays."""
    r = random.Random(3)
    base = [r.choice(WORDS) for _ in range(150)]
    rows = [(i, " ".join(changed(r, base, 0.025 if i % 10 else 0.05))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sets = C.described(docs, 3).select("key", "n", "sig").withColumn("w", C.F.lit(1)).cache()
    small, dense = C.tree_nodes(sets, 6, 10)
    assert sum(d.count() for d in dense) > 100
    want = plain_python(rows)
    assert 2 < len({x[2] for x in want}) < 80  # one large component and single ones
    assert found(C.near_duplicates(docs, limit=10)) == want


def test_heavy_sets_are_dense_nodes(spark):
    r = random.Random(4)
    base = [r.choice(WORDS) + r.choice(WORDS) for _ in range(9000)]
    rows = [(i, " ".join(changed(r, base, 0.01))) for i in range(6)] + [(9, "short one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(C.near_duplicates(docs, limit=2)) == plain_python(rows)


def test_edges(spark, edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert found(C.near_duplicates(edges)) == plain_python(rows)
    assert C.near_duplicates(nothing).collect() == []
    odd = spark.sql("SELECT id AS doc_id, concat('a b c ', cast(X'FF' AS STRING), ' d') AS text FROM range(3)")
    assert found(C.near_duplicates(odd)) == [(i, 3, 0) for i in range(3)]


def test_query_on_the_documents(spark, small):
    from tests.conftest import SF_DIR

    df = QUERIES["op12_minhash_near_dedup"](spark, SF_DIR)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = df.collect()
    want = plain_python([(r["doc_id"], r["text"]) for r in small("documents").select("doc_id", "text").collect()])
    assert sorted((tuple(r)[:3] for r in rows), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_tokens_estimate_the_similarity():
    r, h = random.Random(8), WordHash()
    base = [r.choice(WORDS) + r.choice(WORDS) for _ in range(30_000)]
    a, b = (C.shingles(" ".join(x).encode(), 3, h) for x in (base, changed(r, base, 0.03)))
    both = len(np.intersect1d(a, b))
    assert abs((C.tokens(a) == C.tokens(b)).mean() - both / (len(a) + len(b) - both)) < 0.15
    assert C.trees_for(0.85, 0.9999) == 6
