"""Training-data operators: one module for each operator, queries in ``queries``, SQL in ``oracle``.

Functions of this subpackage that run in tasks are sent by value, so executors
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
