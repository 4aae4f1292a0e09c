"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it. Functions that run inside Python
workers are pickled by value, so an executor needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
