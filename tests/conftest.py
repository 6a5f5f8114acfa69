import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tokenloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="4", partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts():
    """A few hundred short texts with the awkward cases among them."""
    import duckdb

    rows = duckdb.sql(
        "SELECT text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id"
    ).fetchall()
    awkward = [
        "", " ", "\n", "a  b", " lead", "tab\tand\n\nlines ", "it's we'll I'd 'S", "naïve çà 漢字 😀",
        "x1²½ ⅷ", " nb sp", "<s>one</s><s> two </s>", "<mask>", "a<pad>b</s>", "<s<s>>",
        "trailing   ", "\x0b\x1c\x85", "aaaa aaaaa aaaaaa",
    ]
    return awkward + [r[0] for r in rows]
