"""tracklake: driving-log scenario mining as Spark DataFrame plans.

Stages: tracks (validated, bucketed) -> safety events -> one feature row per
scenario -> near-duplicate removal and stratified sample -> unit-vector
embeddings with exact nearest-neighbour search -> SQL catalog and KPI marts.
"""

from tracklake.settings import DEFAULT, Settings

__all__ = ["DEFAULT", "Settings"]
