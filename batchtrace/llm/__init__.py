"""Training-data operators and the corpus pipeline built from them.

The tasks' Python functions travel to the executors by value, so executors need
the listed libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
