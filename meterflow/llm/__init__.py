"""Operators for large training-data pipelines. Nothing else in the library imports this package.

Functions that run in Python workers travel by value, so executors need the third-party libraries
but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
