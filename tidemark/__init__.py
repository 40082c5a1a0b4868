"""Time-series operators for fleets of moving sensor platforms, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package with the task and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
