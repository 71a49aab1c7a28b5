"""Queries over the driver's tables, each next to the SQL that must give the same rows."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
