"""Import every query module so the catalog is complete, then expose it."""

from . import (queries_extra, queries_features, queries_io, queries_mart,  # noqa: F401
               queries_ml, queries_sketches, queries_summary, queries_tables,
               queries_validation)
from .catalog import ORACLES, QUERIES  # noqa: F401
