"""Operators for large text corpora, built on Spark.

Each module holds one operator; ``queries.py`` binds them to the tables.
Nothing else in the library imports this package. Task functions are shipped
by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
