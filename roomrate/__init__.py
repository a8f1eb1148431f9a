"""roomrate: rental room pricing as Spark DataFrame plans.

``sources`` reads the input tables, ``functions`` holds Column expressions,
``operators`` the reusable relational building blocks, ``plans`` the jobs and
the end-to-end pipeline, ``sinks`` the dated CSV outputs.
"""
