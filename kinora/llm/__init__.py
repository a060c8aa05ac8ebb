"""Operators for building training data: URL rules, PII, packing, licenses, toxicity, tokens, fingerprints, quality, joins.

Every operator takes a DataFrame and the names of its key and text columns, reads only those columns (so other
columns may have any name) and returns a DataFrame.  Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are shipped by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
