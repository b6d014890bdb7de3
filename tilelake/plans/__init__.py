"""tilelake.plans"""
