"""Strandline: a lakehouse toolkit for delivery-based registers on PySpark.

Deliveries are read and typed (``sources``), reduced to one winner per business
key with the losers quarantined, kept as type 2 history, checked and compared
(``operators``), composed into whole flows and reports (``plans``) and fed
incrementally (``streaming``).  Every operator takes and returns DataFrames.
"""
