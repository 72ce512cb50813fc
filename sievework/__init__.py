"""sievework: a Spark-native engine for curating question/answer collections.

Functions that run in Python workers are shipped by value, so executors need
only Spark, numpy, pandas and pyarrow, not a copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
