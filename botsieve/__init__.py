"""botsieve: click-bot detection and table queries as Spark plans.

Batch and Structured Streaming share the same DataFrame functions:
``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame),
``sources``, ``plans`` (jobs and the registered queries), ``streaming``.
"""
