"""Session-conversion analytics on Spark DataFrames.

Sub-packages: ``sources`` (readers, writers), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame), ``streaming``
(the same operators per micro-batch) and ``plans`` (registered queries).
"""
