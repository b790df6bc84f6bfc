"""A few registered queries against their SQL on the smallest tables; the rest by tools/compare.py."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", ["topic_co_occurrence", "filing_health", "node_registry", "edge_upsert_last", "degree_undirected", "contained_names", "validated_triples", "entity_clusters", "table_markdown", "canonicalize_documents", "p3_found", "p3_snapshots"])
def test_query(spark, name):
    from tools.compare import differs, duck

    assert differs(spark, duck(D), D, name) == ""


def test_names_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
