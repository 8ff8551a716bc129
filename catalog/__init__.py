"""Every inventory entry as a Spark query on the test tables, with its SQL counterpart."""

import sys

from pyspark import cloudpickle

from catalog import aggregates, fields, joins, people, sinks, skills, sources, vectors

# The stand-in encoder travels inside its task, as the library's functions do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CASES: dict = {}
for _module in (sources, sinks, fields, joins, aggregates, skills, vectors, people):
    CASES.update(_module.CASES)
