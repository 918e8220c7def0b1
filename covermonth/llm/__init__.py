"""Operators for preparing language-model training data, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors get the code of tasks with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
