"""basketry — basket analytics and recommendation as Spark DataFrame plans.

Order lines in, ranked recommendations, association rules, ranking metrics and
report tables out. Every step is a lazy DataFrame plan (or an MLlib fit), so
the same code runs on ``local[*]`` and on a cluster.
"""

from basketry.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
