"""Training-data operators: sharding, deduplication, tokens, quality, language, mixing, licenses.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their DuckDB SQL.
"""
