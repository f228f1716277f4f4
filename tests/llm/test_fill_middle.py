"""Fill-in-the-middle against plain Python, with exact round trips."""

import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import fill_middle as FM

ODD = ["", None, "a", " ", "ab cd", "x<P>y", "<S>", "<M", "a<", "<M>", ">P<S", "<<P", "ñé 東京 😀x😀\n\r \x85z", "\n\n", "$1 \\2 {3}+ (a|b)", "a" * 70_000, "ab, " * 40_000, "😀" * 30_000]


def plain_python(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return len(units), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_against_plain_python(spark):
    rows = [(i * len(ODD) + j, t) for i in range(12) for j, t in enumerate(ODD)] + [(None, "no id at all"), (7, "ab cd"), (7, "ab cd"), (-3, "minus three")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = FM.fill_in_middle(docs).withColumn("back", FM.restored()).collect()
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made), key=repr)
    want = sorted(((i, *plain_python(i, t)) for i, t in rows), key=repr)
    assert got == want
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}
    assert all(r["back"] == r["text"] for r in made)


def test_edges(edges, nothing):
    made = FM.fill_in_middle(edges)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text", "output"]
    assert made.count() == edges.count()
    assert made.filter(FM.restored() != F.col("text")).count() == 0
    assert FM.fill_in_middle(nothing).count() == 0


def test_malformed_text_is_repaired_first(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("concat('ab ', cast(X'FF41C3' AS STRING), ' cd')").alias("text"))
    made = FM.fill_in_middle(docs).withColumn("back", FM.restored()).collect()
    assert {r["text"] for r in made} == {"ab �A� cd"} == {r["back"] for r in made}
    assert {r["n"] for r in made} == {7}


def test_shares(small):
    forms = dict(FM.fill_in_middle(small("documents").select((F.col("doc_id") + 100_000).alias("doc_id"), "text"), plain_percent=50, spm_percent=50).groupBy("form").count().collect())
    total = sum(forms.values())
    assert abs(forms["plain"] / total - 0.5) < 0.12 and abs(forms["spm"] / total - 0.25) < 0.12
