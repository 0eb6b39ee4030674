"""rillflow: Spark-native real-time warehouse operators.

Behaviour-log cleaning, new-visitor repair and channel split; config-driven
dimension routing with cell-level upserts; comment enrichment by a dictionary
lookup join. Every transform is ``DataFrame -> DataFrame`` and runs unchanged
on batch tables and on Structured Streaming micro-batches, except the stateful
ones, which have a batch form in ``operators`` and a stream form in
``streaming``.
"""

__version__ = "0.1.0"
