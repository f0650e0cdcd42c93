"""The query builder, its lowering to DataFrames and what runs it."""
