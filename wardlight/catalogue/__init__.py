"""Named queries on the driver tables, each with the SQL that must give the same rows."""


def load():
    """All registered queries by name."""
    from wardlight.catalogue import models, pages, pipeline, relational, scalar, tables  # noqa: F401
    from wardlight.catalogue.registry import REGISTRY

    return REGISTRY
