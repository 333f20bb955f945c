"""Millrace: analytics operators as pure ``DataFrame -> DataFrame`` functions on Spark."""

import sys

from pyspark import cloudpickle

# Python workers get these modules by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
