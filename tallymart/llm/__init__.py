"""Operators of a training-data pipeline over a table of documents.

Every operator takes DataFrames and the names of the columns it reads, selects
those alone (extra columns never clash with its own) and treats a null text as
an empty one unless its docstring says otherwise.

Functions that run in Python workers are sent by value, so executors need the
public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
