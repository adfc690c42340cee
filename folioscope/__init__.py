"""Prepare document collections for question answering with PySpark.

Every step takes DataFrames and returns DataFrames.  See the README for a tour.
"""

import sys

from pyspark import cloudpickle

# Python stages are shipped to the executors by value, so a cluster needs no copy of
# this package on its workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
