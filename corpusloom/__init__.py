"""Document analytics, retrieval and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
