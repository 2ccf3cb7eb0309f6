"""Every query of the library by name, with its DuckDB SQL."""

from millrace.operators import cleaning, corpus, dedup, entities, parsing, prompts, qa, retrieval, splits, stages, statistics, tokens, web

_MODULES = (cleaning, statistics, dedup, splits, qa, prompts, retrieval, web, entities, parsing, stages, tokens, corpus)
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
