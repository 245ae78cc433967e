"""corpusmill: corpus selection, stylometry and group comparison as Spark jobs.

Layout

* ``params``     fixed values and parameters, and their dimension tables
* ``functions``  column expressions (text, catalog, tokens, names, statistics)
* ``operators``  DataFrame to DataFrame operators
* ``sources``    scans and sinks
* ``plans``      end-to-end jobs and the registered queries
* ``streaming``  incremental feature extraction
"""
