"""Every query against its SQL at the smallest scale, and the rules for the entry module."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql_or_its_own_test():
    """The operators for large corpora that SQL cannot express are named in their own tests."""
    assert set(SQL) <= set(QUERIES)
    own = "".join(path.read_text() for path in (Path(__file__).parent / "llm").glob("test_*.py"))
    assert [name for name in QUERIES if name not in SQL and name not in own] == []


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF).toPandas())
    want = canonical(duck.execute(SQL[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=0)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.split for r in rows} == {"dev", "train"}


def test_scores_and_tags_of_a_place_come_from_its_hash(spark, tmp_path):
    """Tags and scores by hand, for a null and a negative id too; they are drawn side by side, not by one md5 expression each."""
    import hashlib

    from tokenloom.catalog import inputs
    from tokenloom.constants import NER_LABELS

    rows = [(7, "one two  three\nfour", "en", "s", 1), (-12, "x " * 130, "en", "s", 1), (None, "a b", "en", "s", 1), (9, None, "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(str(tmp_path / "documents.parquet"))

    def h(*parts):
        return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()

    tagged = {r.sent_id: r for r in inputs.tagged(spark, str(tmp_path)).collect()}
    assert set(tagged) == {"7:0", "7:1", "-12:0", "0"}
    want = {}
    for sent, row in tagged.items():
        assert row.ner == [inputs.TAGS[int(h(sent, i)[:8], 16) % 16] for i in range(len(row.token))]
        for i, name in enumerate(row.ner):
            label = NER_LABELS.get(name, -100)
            sure = int(h(sent, i)[8:16], 16) % 10 < 8
            want[sent, i] = label, [int(h(sent, i, k)[:8], 16) / 2**32 + (2.0 if sure and k == label else 0.0) for k in range(15)]
    scored = inputs.predictions(spark, str(tmp_path))
    assert {(r.sent_id, r.pos): (r.label, r.logits) for r in scored.collect()} == want
    assert "md5(" not in scored._jdf.queryExecution().toString()
