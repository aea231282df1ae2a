"""Operators for preparing training data: thirteen DataFrame-in, DataFrame-out operators and their queries."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so executors don't need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
