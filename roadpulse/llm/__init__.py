"""Operators and queries for preparing training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
