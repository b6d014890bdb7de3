"""Training-data operators over document tables. Nothing else in tilelake imports this subpackage."""
