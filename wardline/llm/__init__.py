"""Operators for preparing text corpora: filters, deduplication, formatting, packing.

Every module holds one operator with its own interface; ``queries`` binds them to the test tables.
Texts are the column ``text`` and ids the column ``doc_id`` unless a parameter says otherwise. Results
are narrow (ids and computed columns), so extra columns of the input cannot clash with them; functions
that filter return the input's own columns.
"""
