"""Named queries over the given tables, each with its SQL where SQL can say the same."""

from tidemark.plans import checks, documents, formats, keyed, metrics, scalars, sessions, star  # noqa: F401
from tidemark.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
