"""Location scoring on Spark: hexagon binning, bounded nearest-neighbour joins, scores and roll-ups."""

__version__ = "0.1.0"
