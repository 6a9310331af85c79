"""Corpus-preparation operators for training data.

One module per operator; ``queries`` registers one ``opN_<name>`` query each.
Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no
# package path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
