"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, so that a cluster
# needs no copy of it beside the one on the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
