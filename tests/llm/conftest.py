import pytest

from closingbell.llm.common import ship

import llm_cases


@pytest.fixture(scope="session")
def session(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def awkward(session):
    return llm_cases.docs_of(session).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(session):
    return llm_cases.docs_of(session, [])


@pytest.fixture(scope="session")
def small(session):
    return session.read.parquet("/root/testdata/sf0.001/documents.parquet")
