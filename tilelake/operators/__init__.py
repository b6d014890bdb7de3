"""tilelake.operators"""
