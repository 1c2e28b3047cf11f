"""Lending and payments data toolkit on Spark: DataFrame in, DataFrame out."""
