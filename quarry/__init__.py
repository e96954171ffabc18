"""quarry: distributed analytics and ML jobs on Spark DataFrames.

Every job takes DataFrames and returns DataFrames. Subpackages:

* ``sources``   readers, writers and the test-table loader
* ``functions`` column expressions (vectors, text, time, parsing)
* ``operators`` data jobs (profiles, encodings, text, models, metrics)
* ``plans``     the registered query catalogue over the test tables
* ``streaming`` Structured Streaming jobs
"""

__version__ = "0.1.0"
