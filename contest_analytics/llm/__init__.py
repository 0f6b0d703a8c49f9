"""Operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
