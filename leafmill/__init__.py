"""Corpus analytics on Spark: operators, sources, functions, plans and streaming helpers."""

import sys

from pyspark import cloudpickle

# Python stages travel to the executors by value, so a cluster needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
