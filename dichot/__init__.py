"""dichot: two-class modelling on Spark DataFrames.

Packages
--------
sources    CSV / Parquet readers and writers (S01-S06)
operators  schema, relational, profile, clean, sampling, ordered kernels,
           glm, inference, selection, models, evaluate
functions  driver-side distributions, reproducible hashing, Gram partials
plans      the cleaning / modelling / scoring jobs and the registered queries
streaming  (nothing: the reference has no streams; see its docstring)
"""

__version__ = "0.1.0"
