"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from tests.check_queries import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert result.startswith(("ok", "rows only")), result


def test_only_reductions_hierarchies_and_merges_have_no_sql():
    # their operators are tested against numpy or plain Python on small fixtures
    assert set(QUERIES) - set(ORACLES) == {"text_topics", "hierarchical_topics", "reduced_embeddings", "merged_topics", "learned_topics"}
