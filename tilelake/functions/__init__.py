"""tilelake.functions"""
