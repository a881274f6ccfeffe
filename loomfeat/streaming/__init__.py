"""Streaming.

The reference is batch-only: it has no stream source, watermark, windowed
state or late-data handling (SURVEY section 2.10). Nothing is built here on
purpose. Every block in ``loomfeat.plans`` is a plain DataFrame function, so
it could run inside ``foreachBatch``, but this library adds no streaming
operator of its own.
"""
