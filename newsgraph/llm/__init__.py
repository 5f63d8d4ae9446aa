"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage; ``queries.py`` maps
the registered query names to functions and, where SQL can express the
result, to DuckDB SQL.

Functions that run inside tasks are shipped by value, so that executors need
numpy, pyarrow and the tokenizer libraries but not this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
