"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it.  Functions that run inside Python
tasks are pickled by value, so a worker needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
