"""tavola — restaurant data-mart analytics expressed as Spark DataFrame plans.

Subpackages:
  sources    readers for landed files and the mart tables built from them
  functions  Column-level helpers (strings, dates, numbers, nested data)
  operators  DataFrame -> DataFrame building blocks (joins, windows, merge, ...)
  plans      composite jobs and views of the mart
  streaming  incremental (Structured Streaming) forms of the table jobs
"""

__version__ = "0.1.0"
