"""Recommendation analytics as Spark jobs: statistics, item/user CF, content, ALS, real time."""

import importlib

from pyspark import cloudpickle

# Functions that run inside Python workers live in these modules.  Shipping them by value means
# executors do not need this package on their own path.
for _name in ("kinora.operators.blocks", "kinora.streaming.recent"):
    cloudpickle.register_pickle_by_value(importlib.import_module(_name))
