"""A Spark-first engine for railway track topology and position points."""

import sys

from pyspark import cloudpickle

# functions that run on executors are sent by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
