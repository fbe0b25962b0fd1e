"""Operators of a training-data pipeline; nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent whole, so workers need not find this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
