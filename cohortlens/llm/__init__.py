"""Operators for large training-data jobs: scoring, filtering, removing copies, mixing and packing of documents.

Each module holds one operator; ``queries`` applies each to its whole table. Nothing outside this package imports it.
Task functions travel by value, so that executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
