"""Registered queries: the operators over the given tables, each with SQL that gives the same rows.

A module has QUERIES (name → function of a session and a folder) and SQL (name → text); a query without SQL
is a sequential helper that its tests hold against a plain version.
"""

from foliospark.plans import concepts_plan, pages_of_concepts_plan, pages_plan, precheck_plan, records_plan, runs_plan, serving_plan

MODULES = (pages_plan, precheck_plan, concepts_plan, runs_plan, records_plan, serving_plan, pages_of_concepts_plan)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
