"""Batch analytics on daily series and nested activity events, as PySpark jobs.

Every public function takes DataFrames and returns DataFrames.  Nothing reads
the clock (``as_of`` is always an argument), nothing collects a table to the
driver, and nothing depends on a hidden session.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the task, so executors need
# not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
