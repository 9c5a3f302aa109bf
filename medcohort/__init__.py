"""medcohort: cohort phenotyping and patient-feature analytics on Spark.

Every public function takes and returns DataFrames; nothing is collected to
the driver except a handful of model parameters (cluster centres, a vector
width) whose size is fixed by the method, not by the data.
"""

__version__ = "0.1.0"
