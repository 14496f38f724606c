"""classmap: assign noisy item descriptions to the leaves of a class tree on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package run inside Python tasks; shipping them by value means
# the executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
