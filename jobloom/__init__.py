"""jobloom: a Spark-first engine for incremental job-posting data."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
