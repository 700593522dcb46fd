"""DataFrame -> DataFrame transforms for each layer and the reporting marts."""

from incidentlake.operators import bronze, gold, marts, quality, silver
from incidentlake.operators.bronze import land
from incidentlake.operators.gold import to_gold
from incidentlake.operators.silver import to_silver

__all__ = ["bronze", "gold", "land", "marts", "quality", "silver", "to_gold", "to_silver"]
