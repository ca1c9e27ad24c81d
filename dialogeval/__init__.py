"""Dialogue-summary dataset building and evaluation as Spark table jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Batch functions travel to the Python workers inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
