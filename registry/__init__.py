"""The registered queries and the SQL they are checked against."""

from registry import analytics, relational, texts  # noqa: F401
from registry.base import ORACLES, QUERIES  # noqa: F401
