"""Operators for a training-data pipeline: tokens, duplicates, search, scoring, packing.

Functions of this package that run inside tasks travel by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
