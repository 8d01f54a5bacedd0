"""Position pricing on Spark: batch and streaming operators for a trading desk."""

import sys

from pyspark import cloudpickle

# Python functions travel to executors by value, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
