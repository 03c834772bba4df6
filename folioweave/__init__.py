"""Spark-native engine that turns scanned, grid-structured documents into validated records."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions of this package travel to the executors by value, so a cluster needs no copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
