"""Ready-made queries over the given tables, with the SQL that states the same result."""

from washline.catalog.oracles import oracle_sql
from washline.catalog.queries import queries

__all__ = ["oracle_sql", "queries"]
