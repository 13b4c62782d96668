"""Streaming.

The reference rebuilds every table in batch; it has no streams, watermarks,
windows over event time or state, so nothing here is owed.  The batch
operators are plain DataFrame functions and apply unchanged inside
``foreachBatch`` if a caller wants to refresh the warehouse from a stream.
"""
