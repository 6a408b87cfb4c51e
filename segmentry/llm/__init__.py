"""Operators of a training-data pipeline, each with its query and SQL.

Functions of this package that run inside tasks are sent by value, so only the
driver needs the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
