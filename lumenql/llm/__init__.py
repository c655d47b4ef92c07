"""Training-data operators: deduplication, filtering, encoding and storage.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and ``oracles.py`` their SQL counterparts.
"""
