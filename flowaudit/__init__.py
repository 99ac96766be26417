"""flowaudit: audit, prepare and evaluate labelled network-flow tables on Spark.

Every operator is a DataFrame -> DataFrame function (or a Spark ML
Estimator/Model pair for fitted statistics).  Subpackages:

* ``sources``   - readers, sinks and the test fixtures derived from the given tables
* ``functions`` - column expressions (labels, missing values, row-wise features)
* ``operators`` - profiling, cleaning, splitting, balancing, models, metrics, forensics
* ``plans``     - end-to-end compositions (audit cleaning, paper pipeline, experiments)
* ``streaming`` - incremental ingest of flow files with the batch schema
"""

__version__ = "0.1.0"
