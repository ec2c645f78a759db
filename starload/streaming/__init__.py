"""Micro-batch loading.

The reference is a batch job; there are no streaming operators to rebuild.
This adapter runs the same loader on each micro-batch of a file stream, for
sources that arrive as new files (``foreachBatch``, exactly the batch code).
"""

from starload.streaming.micro_batch import load_stream

__all__ = ["load_stream"]
