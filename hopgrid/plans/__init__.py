"""Queries over the given tables, each with the SQL that must give the same rows."""

from hopgrid.plans import feeds, figures, matching, tracks

_GROUPS = (matching, figures, tracks, feeds)
QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
