"""Operators for building language-model training corpora with Spark.

Nothing else in the library imports this package.  Functions of this package
that run inside tasks are shipped with the job itself (pickled by value), so
executors need the third-party libraries they use but no copy of this package.
"""
from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
