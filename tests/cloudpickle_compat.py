"""Test classes travel to the workers by value."""

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module])
