"""DataFrame operators: DataFrame in, lazy DataFrame out."""
