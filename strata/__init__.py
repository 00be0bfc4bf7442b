"""Strata: a layered warehouse load (raw -> conformed -> star schema -> reports) written as PySpark plans."""
