"""Queries and SQL of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

from glossaria.llm import byte_bpe, chat_format, lexical_search, line_dedup, mixture_packing, packing, quality_rules, revisits, sharding, simhash, token_alignment, url_filter, webp

MODULES = (url_filter, quality_rules, chat_format, sharding, revisits, line_dedup, packing, byte_bpe, simhash, webp, token_alignment, mixture_packing, lexical_search)


def queries() -> dict:
    import corpus_pipeline

    return {k: v for m in MODULES for k, v in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
