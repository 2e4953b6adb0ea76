"""entityflow: tracked-entity data processing on Spark DataFrames.

Sub-packages
------------
functions   Column -> Column expressions (names, times, urls, labels, text)
operators   DataFrame -> DataFrame steps (dedup, resolve, enrich, chunks, graph, vectors ...)
sources     readers and page extractors
sinks       flat files, published tabs, the envelope store
plans       whole record-type plans composed from the above
streaming   Structured Streaming twins of the batch operators
"""
