"""boardsmith: forum-post refinement on Spark.

Landed pages, API dumps and CSV go in; clean, numbered, batched, parsed, categorised,
vectorised and searchable posts come out.  Every operator is a DataFrame -> DataFrame
function built from Spark SQL expressions, joins, aggregates and windows.
"""

__version__ = "0.1.0"
