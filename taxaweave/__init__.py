"""taxaweave: Spark-native harmonisation of overlapping taxonomy sources.

Layers: ``sources`` (robust delimited ingest), ``functions`` (Column
expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (the conform / merge / dedupe / fill / crosswalk pipeline) and
``streaming`` (incremental file ingest).
"""

__version__ = "0.1.0"
