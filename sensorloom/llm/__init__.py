"""Operators for building language-model training data, each on Spark DataFrames.

Nothing else in the library imports this subpackage; its queries join the registry only when it
can be imported.
"""
