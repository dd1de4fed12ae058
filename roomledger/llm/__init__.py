"""Operators for preparing language-model training data, each one Spark job over a documents table.

Nothing outside this subpackage imports it. Functions that run in Python workers are sent by value,
so executors need only Spark, numpy, pandas and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
