"""Touchline: league results and player-value analytics on Spark DataFrames."""
