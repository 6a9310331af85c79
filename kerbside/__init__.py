"""kerbside: listing analytics on Spark."""
