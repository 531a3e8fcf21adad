"""encore: listening-event recommendations as Spark DataFrame operators.

Every operator is a plain function from DataFrame(s) and parameters to a
DataFrame, with no actions inside, so the batch pipelines and the
Structured Streaming ``foreachBatch`` path share them.
"""

__version__ = "0.1.0"
