"""tilelake: tiled-image preprocessing and relational raster algebra as PySpark plans."""

__version__ = "0.1.0"
