"""Sensor, click-stream and text analytics as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# User functions and state processors travel to the Python workers with the query, so the
# package needn't be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
