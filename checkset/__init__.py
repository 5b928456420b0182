"""Every operator as a query over the driver tables, next to its SQL twin."""

from checkset import classifying, cleaning, combining, extracting, feeds, jobs, planning

MODULES = [feeds, planning, extracting, cleaning, classifying, combining, jobs]


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
