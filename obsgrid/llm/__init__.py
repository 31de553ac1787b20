"""Operators for preparing training data: mixing, filtering, extraction, deduplication, encoding.

Each module holds one operator and the query that applies it to its whole table. Nothing else
in the library imports this subpackage. Its functions travel to the executors by value, so a
cluster needs the third-party packages on its workers but not this one.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
