"""tandem: parallel-text preparation, batch scoring and translation evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
