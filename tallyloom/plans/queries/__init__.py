"""Named queries over the given tables, each with the SQL that states its result.

A query builds an input of the right shape out of whole tables, applies one
operator of the library and returns what comes out.
"""

from tallyloom.plans.queries.base import ORACLE, QUERIES
from tallyloom.plans.queries import (  # noqa: F401  (they fill the registry)
    frames,
    reading,
    scalars,
    sources,
    tables,
)

__all__ = ["ORACLE", "QUERIES"]
