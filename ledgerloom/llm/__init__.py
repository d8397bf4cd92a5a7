"""Training-data operators: texts, archives, near copies, filters, packing."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that they run
# where the package is on the driver's path only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
