"""Operators of a training-data pipeline over text tables."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need the libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules["marlstone"])
