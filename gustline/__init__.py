"""Sensor alert analytics on Spark: detect, suppress, report and land readings."""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel with the job, so that executors need no
# installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
