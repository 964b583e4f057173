"""Operators on series: DataFrame in, DataFrame out."""
