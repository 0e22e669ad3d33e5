"""Registered queries by subject."""

from rollmatch.queries import (  # noqa: F401
    columns, filling, jobs, joining, matching, merging, reshaping, scalars, sheetjobs, storage, summaries,
)
from rollmatch.queries.registry import ORACLES, QUERIES  # noqa: F401
