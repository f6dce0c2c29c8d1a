"""Operators of a training-data pipeline: quality, packing, chat, secrets, duplicates, tokens."""
import sys

from pyspark import cloudpickle

# Functions of this folder travel with the tasks, so executors need no copy of the code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
