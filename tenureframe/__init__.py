"""Spark-native analytics over HR tables whose rows carry a validity interval.

Layers, from the bottom: ``functions`` (column expressions), ``operators``
(DataFrame in, DataFrame out), ``sources`` and ``sinks`` (tables in and out),
``plans`` (cleaning, data quality, reports and the batch jobs made of them).
Every date that enters a result is a parameter.
"""
