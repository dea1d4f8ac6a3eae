"""stockroom: order, inventory, promotion, loyalty and return analytics on Spark.

Every operator is a pure function from DataFrames (plus plain parameters) to
DataFrames. Reading, writing and session set-up live in ``sources``,
``plans`` and ``session``; Catalyst and AQE choose the physical plan.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: an executor needs no
# copy of this package, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["session"]
