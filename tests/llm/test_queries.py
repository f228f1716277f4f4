"""The registered queries: contract columns, and SQL twins where there are any."""

from collections import Counter

import pytest

from tests.conftest import SF_DIR
from tidemark.llm.queries import ORACLES, QUERIES

# The columns of the contract.
COLUMNS = {
    1: "doc_id fingerprint component_id",
    2: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    3: "doc_id held_out score predicted",
    4: "doc_id n_words n_removed kept_sha256",
    5: "doc_id size source_size target taken",
    6: "doc_id held_out n_tokens n_known train_tokens base_score score",
    7: "doc_id n_words n_hit n_items items_sha256 contaminated",
    8: "doc_id size text_crc32 law shard slot grown_shard",
    9: "doc_id n_words n_base first_word last_word base_labels labels score",
    10: "page_id host path rule verdict",
    11: "lang rank phrase a l r n score",
    12: "doc_id n_shingles component_id kept",
    13: "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


def test_every_operator_has_one_query():
    import __spark_entry__ as entry

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n.split("_")[0] in ("op9", "op10", "op5")])
def test_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.columns == COLUMNS[int(name[2:].split("_")[0])].split()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = COLUMNS[int(name[2:].split("_")[0])].split()
    assert df.columns == columns
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want)
