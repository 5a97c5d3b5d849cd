"""Operators of a training-data pipeline (text, vectors, conversations, pages).

Nothing else in the library imports this subpackage.  ``ship`` registers it for
pickling by value, so executors need no copy of the package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
