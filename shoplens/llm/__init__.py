"""Operators for training-data pipelines over the ``documents`` / ``embeddings`` tables.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Task code is shipped by value, so executors
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
