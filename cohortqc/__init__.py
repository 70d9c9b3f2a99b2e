"""Quality control of very large RNA-sequencing cohorts, as PySpark DataFrame operators."""
