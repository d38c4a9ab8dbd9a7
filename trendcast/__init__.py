"""Event trends, segmentation and forecasting as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Grouped functions travel with their helpers, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
