import glob
import os

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the smallest documents table."""
    t = pq.read_table(glob.glob(os.path.join(SF, "documents.parquet"))[0])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


ODD = [None, "", " ", "\n\t \n", "a", "a b", "a b c", "é" * 30, "word " * 5000, "x" * 5000, "İstanbul ẞ Σας <|endoftext|> </s>", "\u00a0tab\x1fsep\u3000wide", "\x00 null"]
SCHEMA = "doc_id bigint, text string, n_words bigint, `tid` string, `score` double, `__quality` int, label string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty and very long texts, repeated rows, a null id and extra columns with clashing names."""
    rows = [(i, t, 7, "x", 1.5, 3, None) for i, t in enumerate(ODD)]
    rows += [(None, "no id at all", None, None, None, None, None), (3, "\n\t \n", 7, "x", 1.5, 3, None), (8, ODD[8], 7, "x", 1.5, 3, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
