"""Operators that prepare text corpora for language-model training.

Every operator takes and returns DataFrames and keeps no state outside the shared scratch folder.
The modules are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
