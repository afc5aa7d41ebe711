"""Registry-snapshot analytics expressed as PySpark plans.

Sub-packages: ``functions`` (column builders), ``operators`` (DataFrame to
DataFrame), ``sources`` (readers, paged data source, snapshot store),
``plans`` (the query catalogue), ``streaming``.  ``llm`` is optional and is
not imported by any of them.
"""

__version__ = "0.1.0"
