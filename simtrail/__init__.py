"""simtrail: Spark-native similar-ticket retrieval, evaluation and article-table sync.

Everything is expressed as DataFrame operators (joins, aggregates, windows,
column functions); Python runs only inside Arrow batches where a matrix
product or a pluggable model needs it.
"""

__version__ = "0.1.0"
