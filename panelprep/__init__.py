"""Market-panel preparation and checking on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python helpers travel with their tasks: executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
