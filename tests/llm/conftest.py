import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def edge_docs(spark):
    from cases import edge_documents

    return edge_documents(spark)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
