"""Queries over the given tables, each with the SQL it must agree with."""

from suite.registry import REGISTRY  # noqa: F401


def load_all() -> dict:
    from suite import activity, catalogs, planning, replication, scalars, selection, streams, typing_checks, versions  # noqa: F401

    return REGISTRY
