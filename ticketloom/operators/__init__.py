"""Relational and model operators over DataFrames."""
