"""Fire-severity analytics as DataFrame and SQL dataflow on Spark."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
