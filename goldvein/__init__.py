"""goldvein: raw -> cleaned -> business layers for commerce data, on plain Spark.

Everything is a DataFrame in, a DataFrame out.  ``sources`` reads and writes,
``functions`` holds column expressions, ``operators`` holds the frame-level
building blocks (deduplication, upsert, dates, measures) and ``plans`` puts them
together into the feeds, dimensions, fact and reports.
"""

#: columns that describe a load, not the business row
TECHNICAL_COLUMNS = ("_source_file", "_ingested_at")
