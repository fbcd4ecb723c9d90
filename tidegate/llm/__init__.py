"""Operators of a training-data pipeline: one module per operator, each with its own method.

Nothing else in the package imports this subpackage.  Functions that Spark ships to Python workers
are pickled by value, so the workers need the third-party libraries but not this repository.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
