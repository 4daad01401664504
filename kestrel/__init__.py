"""kestrel: a Spark-native build of a sales-funnel and revenue reporting chain.

Layers: ``sources`` (input tables) -> ``plans.staging`` -> ``plans.intermediate``
-> ``plans.marts``; generic operators live in ``operators`` and column
functions in ``functions``.
"""

__version__ = "0.1.0"
