"""citeloom: bibliographic record analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Arrow functions are sent to the workers by value, so no package needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
