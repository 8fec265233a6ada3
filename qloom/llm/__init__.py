"""Operators of a training-data pipeline over documents and pages."""

import sys

from pyspark import cloudpickle

# functions sent to Python workers carry their code, so that workers need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
