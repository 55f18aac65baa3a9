"""Operators of a training-data pipeline; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel by value, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
