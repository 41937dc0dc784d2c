"""pacelake: race-results analytics on Spark.

Layers (all plain DataFrame / SQL expressions that Catalyst optimises):

* ``sources``    – result-file readers (batch and streaming), the race feed
                   derived from the star-schema test tables, sinks.
* ``functions``  – column helpers and the silver cleaning transform.
* ``operators``  – column-parameterised analytics and data-quality operators.
* ``plans``      – the star schema, serving views, and the named query catalogue.
* ``streaming``  – the incremental bronze -> silver -> gold refresh.
"""

__version__ = "0.1.0"
