"""The registered queries of the core operators and their SQL."""

from furrow.plans import crop_queries, file_queries, model_queries, scalar_queries, spatial_queries

_MODULES = (scalar_queries, crop_queries, spatial_queries, model_queries, file_queries)
#: Queries that do less than their whole job and stay unregistered until they are mended.
HELD: frozenset[str] = frozenset()
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items() if k not in HELD}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items() if k not in HELD}
