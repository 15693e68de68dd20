"""recoengine: review curation, sentiment labels and recommendations as Spark plans.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from DataFrame, Window and ``pyspark.ml`` calls.  No
operator triggers an action except where stated (lineage cuts through
``checkpoint`` in :mod:`recoengine.operators.ranking`).
"""

__version__ = "0.1.0"
