"""PySpark-native preparation, profiling, training and scoring of tabular data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a session
# works with the package on the driver alone.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
