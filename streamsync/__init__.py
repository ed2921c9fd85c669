"""Change-data-capture and event-stream synchronisation on PySpark.

Every operator takes a DataFrame and returns a DataFrame, and gives the same
answer on a batch and on a stream.  IDs such as ``P3`` or ``K5`` in docstrings
"""
