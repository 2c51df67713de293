"""Operators for training-data pipelines: deduplication, scoring, tokens, mixing, secrets.

Nothing else in the library imports this subpackage.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this subpackage that run in Python workers travel by value, so
# executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
