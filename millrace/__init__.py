"""Named streams, record chains, routing and keyed state as PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
