"""Training-data operators: filtering, deduplication, mixing, packing, scoring and search.

Every module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries and ``oracle`` their SQL. Nothing
outside this subpackage imports it.
"""
