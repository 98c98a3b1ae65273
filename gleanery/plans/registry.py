"""All registered queries, gathered from the plan modules."""

from gleanery.plans import corpus, features, json_files, models, moderation, normal, sentiment, streams, terms

MODULES = [terms, features, moderation, sentiment, json_files, streams, normal, corpus, models]


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
