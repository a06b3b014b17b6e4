"""Spark-native analytics for driving trajectories, road maps and large corpora."""

import sys

from pyspark import cloudpickle

# Executors need not have this package on their path: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
