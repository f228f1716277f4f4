import random

import pytest

EXTRA = "th bigint, did bigint, size int, shard int, slot string, places string, n_words int, root string, kept boolean, word string"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
WORDS = "the of and to in is that it for on was be with as by at from his her not but had are this have an they which one".split()


def row(doc_id, text, lang="en", source="a"):
    """A document with columns that operators use as names of their own."""
    return (doc_id, text, lang, source, len(text or ""), 1, 2, 3, 4, "5", "6", 7, "8", True, "9")


def prose(seed, n, words=WORDS):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", "", ",", "."]) + ("" if r.random() < 0.9 else "\n") + r.choice(["", "x", "ing", "ed"]) for _ in range(n))


def edge_rows():
    shared = prose(99, 60)
    rows = [
        row(1, None), row(2, ""), row(3, " \t\n\x0b "), row(4, "one"), row(5, "two words"), row(6, prose(6, 30)), row(7, prose(7, 200)),
        row(8, prose(7, 200)), row(9, prose(7, 199) + " changed"), row(10, prose(10, 120), None, None), row(11, prose(11, 90), "de", "b"),
        row(12, prose(12, 40) + " " + shared + " " + prose(13, 40), "fr", "c"), row(13, shared, "fr", "c"), row(14, shared + " " + shared, "es", "d"),
        row(15, "word " * 300, "en", "b"), row(16, prose(16, 20000), "en", "c"), row(17, "ÀÉÎ ñandú ДОМ 東京 " * 20, "xx", "e"),
        row(None, prose(18, 80)), row(None, None), row(20, prose(20, 70)), row(20, prose(20, 70)), row(20, prose(21, 70)), row(-5, prose(22, 60)),
    ]
    return rows


@pytest.fixture(scope="session")
def docs_ddl():
    return DOCS


@pytest.fixture(scope="session")
def edges(spark, tmp_path_factory):
    """Null, empty, odd and very long texts, null and repeated ids, repeated rows, clashing columns; read from a file."""
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame(edge_rows(), DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    from tests.conftest import SF_DIR

    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
