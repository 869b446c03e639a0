"""Spark-native analytics operators and ready-made plans."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
