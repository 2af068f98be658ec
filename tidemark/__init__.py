"""Layered analytics over keyed, versioned event records, built on Spark DataFrames."""
