"""Operators and pipeline for training data. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel whole, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
