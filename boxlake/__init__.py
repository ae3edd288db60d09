"""boxlake: a PySpark-native analytics engine for annotation and training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
