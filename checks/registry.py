"""All registered queries."""

from . import queries, queries_pairs  # noqa: F401
from .queries import ORACLES, QUERIES  # noqa: F401
