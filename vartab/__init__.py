"""vartab: variant-annotation tables on Spark.

Readers live in ``vartab.sources``, writers in ``vartab.sinks``, Column
helpers in ``vartab.functions``, DataFrame-to-DataFrame operators in
``vartab.operators`` and end-to-end assembly in ``vartab.plans``.
No operator triggers an action except the writers.
"""

__version__ = "0.1.0"
