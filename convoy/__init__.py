"""Fleet telemetry analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so only the driver needs it on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
