"""jobloom: job-market analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel inside the task, so executors
# need nothing installed beyond PySpark, numpy and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
