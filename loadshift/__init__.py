"""loadshift: household energy load shifting as Spark jobs."""

import sys

from pyspark import cloudpickle

# Grouped pandas functions travel to the executors by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
