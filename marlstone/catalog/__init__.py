"""The registered queries and the SQL each one is compared with."""

from importlib import import_module

PARTS = ("text", "retrieval", "vectors", "evaluation", "medallion", "graph", "personal_data", "conversations",
         "streams", "files")


def _merged(attribute):
    return {k: v for part in PARTS for k, v in getattr(import_module(f"marlstone.catalog.{part}"), attribute).items()}


def all_queries():
    return _merged("QUERIES")


def all_sql():
    return _merged("SQL")
