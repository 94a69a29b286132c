"""tidepool: continuous-analytics operators as plain DataFrame -> DataFrame functions.

Sub-packages
------------
sources    table readers, choice sources, batch-id assignment, request tables
functions  column-level helpers (suffixes, split rules, rendering, time arithmetic)
operators  counts, slots, sliding windows, ranking, joins, reach, changelogs,
           distribution helpers and the UDF surface
streaming  Structured Streaming bodies (file sources, versioned foreachBatch
           state, keyed running state)
plans      the named queries on the driver tables and their SQL oracles
"""

import sys

from pyspark import cloudpickle

# Python functions of this package (combiners, UDTFs, Arrow batch functions)
# travel to the executors by value, so the workers need no install or path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tidepool.session import get_session, checkpoint_dir  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
