"""Review analytics on Spark: term selection, text features, moderation, corpus statistics.

Every operator is a plain function from DataFrames to a DataFrame.  Small tables
(lexicons, category sizes) are joined without broadcast hints: Catalyst broadcasts
them when the file or the finished shuffle stage is known to be small, and falls
back to a shuffled join, with adaptive skew splitting, when it is not.
"""
