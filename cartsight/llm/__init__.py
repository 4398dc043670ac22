"""Operators of a training-data pipeline: language, quality, secrets, personal data, duplicates, mixing, shards."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that a cluster needs no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
