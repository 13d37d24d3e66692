"""Operators of a training-data pipeline: scoring, near-duplicate joins, archives,
extraction, mixing and pseudonyms. Nothing outside this folder imports it.

Functions of this folder that run inside tasks travel by value, so executors need not have
the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
