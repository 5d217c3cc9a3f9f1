"""Operators of a training-data pipeline, each a set of Spark jobs over whole tables.

Nothing else in the library imports this subpackage. Functions that run on
executors are shipped by value, so the workers need numpy, pyarrow, xxhash and
tokenizers but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
