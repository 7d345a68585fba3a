"""Training-data operators: DataFrame in, DataFrame out.  Nothing outside imports this package."""
