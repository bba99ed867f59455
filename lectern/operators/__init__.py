"""DataFrame operators: DataFrame in, DataFrame out, for batch and for foreachBatch."""
