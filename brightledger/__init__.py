"""brightledger: customer analytics on Spark.

Bank and order tables are cleaned and banded (``plans.staging``), rolled up per
customer and per account (``plans.silver``) and summarised for executives
(``plans.gold``). Every step is a function from DataFrames to a DataFrame.
"""
