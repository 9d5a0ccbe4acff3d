"""parlance: transcript analytics and training-data operators as PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

from parlance.config import ChunkConfig

# functions for Python workers travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ChunkConfig"]
