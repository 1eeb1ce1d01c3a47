"""Loan-risk analytics on Spark: monthly snapshots in, star schema and labels out.

Layers
------
``functions``  column expressions (``Column -> Column``)
``operators``  relational operators (``DataFrame -> DataFrame``)
``sources``    schema contracts, readers, writers, staging
``plans``      source cleaners, star-schema mart, gold tables, the whole run
``streaming``  refresh of cleaned snapshots from newly arrived bronze files
``workload``   every operator expressed over the test tables, with SQL oracles
"""

__version__ = "0.1.0"
