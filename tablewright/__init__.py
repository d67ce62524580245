"""Composable Spark DataFrame operators for analytical data preparation and forecasting."""

import sys

from pyspark import cloudpickle

# helper functions used inside Python tasks travel with the task, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
