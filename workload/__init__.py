"""Registered queries over the test tables, each with an independent SQL check where one exists."""


def all_queries():
    """(queries, sql), importing every query module once."""
    from workload import registry, shape_queries, source_queries, table_queries  # noqa: F401

    return registry.QUERIES, registry.ORACLES
