"""Spark-native tabular machine-learning analytics.

Every operator is a function over DataFrames.  Import from the sub-packages:

* ``tabstride.sources``   readers and writers
* ``tabstride.functions`` column expressions and row kernels
* ``tabstride.operators`` relational, profiling, metric, feature and model operators
* ``tabstride.plans``     end-to-end flows built from the operators
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
