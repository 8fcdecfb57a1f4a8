"""Queries over the driver's tables, each beside the SQL another engine answers it with."""

from workload import audits, datasets, jsontexts, labelling, scoring, tokens, tracked

_MODULES = (tokens, labelling, tracked, scoring, audits, datasets, jsontexts)


def queries():
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
