"""tonality: Spark-native sentiment analytics over text tables and streams.

Every operator is a lazy ``DataFrame -> DataFrame`` transformation; the
sub-packages group them by role:

* ``sources``   – scans and sinks (driver tables, corpus files, CSV, vectors, archives)
* ``functions`` – column expressions (tokenising, verdict text, array/tensor helpers)
* ``operators`` – relational operators (vocabulary joins, pooling, dataset assembly,
                  scoring, evaluation, classifiers)
* ``plans``     – physical-plan helpers (size-checked broadcast, distributed ordinals,
                  staging of do-once tables)
* ``streaming`` – Structured Streaming scoring
"""

__version__ = "0.1.0"
