"""Request forms (filters, aggregations, stored queries) turned into DataFrames."""
