"""Operators of a training-data pipeline. Nothing outside this package imports it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: a cluster needs no copy of the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
