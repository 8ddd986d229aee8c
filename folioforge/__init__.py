"""Passage analytics on Spark: paged documents to validated passages, retrieval, and reports."""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
