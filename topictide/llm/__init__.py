"""Operators and queries that prepare a training corpus.

Functions of this package travel to the Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
