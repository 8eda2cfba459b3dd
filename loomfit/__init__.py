"""Preparation, resampling, linear models and clustering of wide tables on Spark DataFrames."""

from pyspark import cloudpickle as _cloudpickle

from .operators import sums as _sums

# Kernels travel to the tasks by value, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sums)
