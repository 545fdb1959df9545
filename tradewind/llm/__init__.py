"""Operators for preparing language-model training data at corpus scale.

Functions that run in Python workers are shipped with their code, so executors need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
