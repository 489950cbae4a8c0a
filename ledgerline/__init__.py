"""Insider-filing analytics as Spark DataFrame jobs.

``sources`` read filings, ``functions`` build column expressions,
``operators`` map DataFrames to DataFrames, ``sinks`` write them and ``plans``
chain everything into whole jobs.
"""
