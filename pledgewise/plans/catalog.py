"""All registered queries."""

from . import aggregates, casework, chaining, corpus, deriving, drafting, filingwork, guarding, joining, queueing, resolution, reviewing, streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
