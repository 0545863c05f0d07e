"""Operators for preparing training text: one module each, built on DataFrames.

Nothing else in the library imports this package. Its functions travel to the
Python workers by value, so executors need the third-party libraries but not
this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
