"""Weekly retail sales analytics and forecasting as plain PySpark.

Every operation takes DataFrames and column names and gives a DataFrame back.
`sources` reads, writes and names tables, `functions` builds columns,
`operators` holds the table operations and the models, and `plans` chains them
into the sales panel and the registered queries.
"""
