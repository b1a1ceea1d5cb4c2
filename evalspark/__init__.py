"""evalspark: evaluate question-answering models on tables, with Spark."""

import sys

from pyspark import cloudpickle

# Ship this package's functions to Python workers by value, so that executors need
# no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
