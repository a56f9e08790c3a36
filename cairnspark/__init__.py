"""A PySpark-native engine for voxel pyramids and large-scale table processing."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their own code, so a cluster needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
