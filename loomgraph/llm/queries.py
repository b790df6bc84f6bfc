"""Queries of the text operators: the dictionaries of all their modules."""

from __future__ import annotations

from loomgraph.llm import queries_a, queries_b, queries_c, queries_d, queries_e, queries_f

_PARTS = [queries_a, queries_b, queries_c, queries_d, queries_e, queries_f]
QUERIES = {k: f for m in _PARTS for k, f in m.QUERIES.items()}
SQL = {k: s for m in _PARTS for k, s in m.SQL.items()}
