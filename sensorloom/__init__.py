"""Spark-native analytics for industrial sensor streams.

Every operator is a plain function from DataFrames (plus parameters) to a DataFrame, so the same
definition serves batch, ``foreachBatch`` and, where no per-sensor state is needed, ``readStream``.
"""
