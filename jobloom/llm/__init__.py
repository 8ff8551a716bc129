"""Corpus preparation for language models: dedup, scans, mixing, sharding, token files, scoring."""

import sys

from pyspark import cloudpickle

# As in the parent package: functions that run in Python workers travel inside the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
