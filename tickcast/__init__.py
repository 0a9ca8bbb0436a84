"""tickcast — daily news sentiment × price series on Spark.

Layers: raw documents → formatted news/prices → daily sentiment and
next-close predictions → combined rows → per-symbol documents, as batch jobs
or Structured Streaming queries with the same semantics.
"""

__version__ = "0.1.0"
