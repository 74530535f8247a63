"""churnlab: subscription-churn analytics as Spark DataFrame jobs.

Sub-packages:
  sources    - readers, parsers and idempotent table sinks
  functions  - Column -> Column helpers (clip, safe ratios, buckets, bands)
  operators  - feature builders, labeller, EDA, metrics, imputation, validation, models, monitoring
  plans      - driver-table bindings, period configs and the query registry with its SQL twins
  streaming  - Structured Streaming scoring and rate jobs
"""

__version__ = "0.1.0"
