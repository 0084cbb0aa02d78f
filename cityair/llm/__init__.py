"""Operators of a training-data pipeline, each as Spark jobs.

Nothing else in the library imports this subpackage; ``queries.py`` lists
the registered queries.
"""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
