"""Operators for training-data pipelines.

Nothing else in the package imports this subpackage.  Each operator is a module
with a general function over any documents table; ``registry`` binds them to
the driver's tables as ``opN_<name>`` queries."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors by value, so a job does not
# depend on the package being installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
