"""Social-post feed processing, merging, export and exact vector search on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need only
# pyspark, numpy, pandas and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
