"""All registered queries (importing the plan modules fills the registry)."""

from . import decisions, learning, routing, series, serving, traces  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
