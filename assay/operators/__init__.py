"""DataFrame operators: each is a function of DataFrames, parameterised by column names."""
