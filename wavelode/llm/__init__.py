"""Operators of a training-data pipeline over a table of documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the code they use, so that it need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
