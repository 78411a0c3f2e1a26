"""Every operator as a named query over the given tables, with its SQL twin."""

from gridmill.registry import columns, feeds, ingest, jobs, lake, periods, quality, shape, streams  # noqa: F401
from gridmill.registry.base import ORACLES, QUERIES  # noqa: F401
