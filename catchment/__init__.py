"""Zonal statistics and calibration bounds on Spark DataFrames."""
