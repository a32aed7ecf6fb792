"""History, temporal-join, hierarchy and tenure operators on Spark DataFrames."""
