"""tilelake.streaming"""
