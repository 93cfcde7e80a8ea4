"""ebbtide: customer-churn analytics as Spark DataFrame jobs.

Layers, lowest first:

* ``names``      column names and fixed values
* ``functions``  column expressions (casts, bands, guarded ratios)
* ``sources``    readers, writers and the order-entry demonstration views
* ``operators``  table operators (anchors, snapshots, look-back, shares, ...)
* ``plans``      feature frames and reports built from the operators
* ``ml``         encode, split, train, evaluate, search and score on Spark ML
* ``jobs``       the end-to-end training and scoring jobs
"""

__version__ = "0.1.0"
