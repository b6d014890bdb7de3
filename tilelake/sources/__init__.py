"""tilelake.sources"""
