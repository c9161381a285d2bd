"""Registered queries: the library's operators over the given tables, each with its SQL check.

``views`` maps the tables to the canonical schemas, ``ctes`` states the same mapping in SQL, and the
``q_*`` modules register queries next to the SQL that must give the same rows.
"""
