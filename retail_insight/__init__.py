"""Retail behaviour and ad-click analytics, written as Spark DataFrame plans.

Batch products (R1, R2, R4) read the visit log and its dimensions; the
real-time products (R3, R5, R6) read an ad-click log, as a batch table or as
a Structured Streaming source. Every operator is a DataFrame -> DataFrame
function, so the same code serves batch, stream (inside ``foreachBatch``) and
SQL users (through temp views).
"""

__version__ = "0.1.0"
