"""Streaming versions of the event-driven steps.

Every `foreachBatch` writes partitions named by run (or a slot named by batch), so a batch that
is tried again replaces its own output.
"""
