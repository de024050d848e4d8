"""Spark-native data integration and analytics: DataFrame operators, sources and plans."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
