"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions go to the tasks by value, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
