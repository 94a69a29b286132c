"""Named queries on the driver tables (``catalog``) and their SQL oracles (``oracle``)."""

from tidepool.plans.catalog import QUERIES
from tidepool.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
