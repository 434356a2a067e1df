"""A Spark-native engine for labelling, searching and classifying georeferenced tiles."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so these need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
