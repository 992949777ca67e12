"""Operators for training-data pipelines; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# functions that run in Python tasks travel with their code, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
