"""Denormalise relational tables into keyed item collections with Spark DataFrames."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors as code, so nothing has to be installed there.
register_pickle_by_value(sys.modules[__name__])
