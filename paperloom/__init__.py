"""Scholarly documents as DataFrames: cleaning, alignment, scoring, learning and rendering on Spark."""
