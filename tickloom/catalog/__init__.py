"""Named queries over the test tables, each with its SQL twin where SQL can say it."""

from tickloom.catalog import (  # noqa: F401
    drift, indicators, market, models, prep, quality, streaming, tables)
from tickloom.catalog.base import ORACLES, QUERIES  # noqa: F401
