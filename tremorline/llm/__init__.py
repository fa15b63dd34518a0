"""Operators for training-data pipelines.

Functions that run in Python workers travel by value, so executors need only
the public libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
