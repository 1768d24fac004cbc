"""Event, text, score and viewing analytics as plain DataFrame-to-DataFrame functions."""

import sys

from pyspark import cloudpickle

# Python tasks get this package's functions with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
