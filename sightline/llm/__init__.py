"""Operators for preparing training data, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Python workers may start where the package cannot be imported.
cloudpickle.register_pickle_by_value(sys.modules["sightline"])
