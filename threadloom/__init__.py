"""threadloom: batch and streaming analytics over forum posts and comments, on Spark."""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with the job, so executors do
# not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
