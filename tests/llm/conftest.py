import os

import pytest
from corpus_cases import DOCS, ODD

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """(doc_id, text) of the smallest documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en" if n % 2 else None, f"s{n % 3}" if n % 4 else None, 0, 5, "q") for n, (i, t) in enumerate(ODD)]
    extra = ", n int, q string"
    return spark.createDataFrame(rows, DOCS + extra)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i != 5), 0) for i in range(1, 14)] + [(None, 1, 0), (6, 0, 0), (6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
