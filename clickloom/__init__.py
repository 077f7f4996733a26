"""Click prediction and offer ranking features, encoders, models and scoring on Spark."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions and classes travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
