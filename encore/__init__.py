"""Live-event analytics expressed as Spark DataFrame, SQL, MLlib and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# the few Python functions used in tasks travel with them, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
