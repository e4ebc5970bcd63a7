"""Customer-lifecycle analytics on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python on executors travel with their job, so a
# cluster needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
