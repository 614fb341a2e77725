"""Queries over the logical tables, each with SQL that gives the same rows."""

from postloom.plans import boards, catalogs, coverage, daily, jobs, package, reports, snapshots, variants

PARTS = (jobs, boards, coverage, snapshots, variants, package, daily, reports, catalogs)
QUERIES = {k: v for p in PARTS for k, v in p.QUERIES.items()}
SQL = {k: v for p in PARTS for k, v in p.SQL.items()}
