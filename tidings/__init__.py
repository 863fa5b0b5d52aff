"""tidings: news, sentiment and price analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames (or Column expressions) and is
built from public PySpark APIs so Catalyst can push filters, prune columns
and pick join strategies. Sub-packages:

- ``sources``   readers, writers and table maintenance (append, upsert, ...)
- ``functions`` column expressions (labels, returns, dates, patterns)
- ``operators`` joins, windows, aggregates, text matching, learning loop
- ``plans``     named queries over the test tables and their SQL oracles
- ``streaming`` Structured Streaming ingest and stateful operators
"""

__version__ = "0.1.0"
