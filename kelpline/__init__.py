"""kelpline: episode and telemetry analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to workers travel by value: the workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
