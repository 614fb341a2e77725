"""Operators that prepare text corpora for language-model training.

Nothing else in the package imports this one; it can be removed as a whole.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors with their code, so these needn't have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
