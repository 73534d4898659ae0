"""Every query of the library and the same in DuckDB's SQL."""

from tidemark.queries import audits, bars, core, operations, quality, research, retrieval, serving, storage, streaming

_MODULES = (core, bars, quality, audits, research, retrieval, operations, serving, storage, streaming)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
