"""Queries over the driver tables, each with the SQL that checks it."""

from checks import closed_forms, model_queries, table_queries, text_queries

QUERY_MODULES = (text_queries, table_queries, model_queries, closed_forms)
