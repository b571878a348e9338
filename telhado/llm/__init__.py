"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks, so workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
