"""growthlake: product analytics for subscription businesses, as PySpark DataFrames."""
