"""Registered queries over the given tables and the SQL they must agree with."""


def load():
    """All registered queries and their SQL."""
    from checks import asset_queries, catalog_queries, operator_queries, order_queries, tender_queries  # noqa: F401
    from checks.registry import QUERIES, SQL

    return QUERIES, SQL
