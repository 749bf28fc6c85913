"""Operators for preparing language-model training data.

Self-contained: nothing outside this folder, ``tests/llm`` and
``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Python workers need no copy of this package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
