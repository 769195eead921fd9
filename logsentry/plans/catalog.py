"""All registered queries, and the SQL of those that have one."""

from __future__ import annotations

from logsentry.plans import evaluation, lasting, modelling, ordered, scoring, storage

_FAMILIES = (ordered, scoring, evaluation, modelling, storage, lasting)

QUERIES = {name: f for family in _FAMILIES for name, f in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
