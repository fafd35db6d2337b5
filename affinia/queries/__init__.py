"""Registered queries over the given tables, and the SQL each one must agree with."""

from affinia.queries import graph, itemsets, profile, recommend, similarity

_AREAS = (profile, itemsets, similarity, recommend, graph)

QUERIES = {name: query for area in _AREAS for name, query in area.QUERIES.items()}
ORACLES = {name: sql for area in _AREAS for name, sql in area.ORACLES.items()}
flagship = itemsets.flagship
