"""Named query plans over the supplied tables, each with an equivalent DuckDB oracle SQL."""

from .catalog import ORACLE_SQL, QUERIES  # noqa: F401
