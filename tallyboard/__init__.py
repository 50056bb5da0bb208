"""tallyboard: survey and business-metric tables on Spark DataFrames.

``sources`` reads and writes, ``functions`` holds column expressions, ``operators`` holds
``DataFrame -> DataFrame`` steps, and ``plans`` composes them into metrics, chart queries and
the load job. Nothing here runs row by row in Python.
"""
