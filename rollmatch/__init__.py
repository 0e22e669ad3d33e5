"""Record roll-up, reconciliation and matching on PySpark DataFrames."""
