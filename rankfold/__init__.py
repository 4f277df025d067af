"""rankfold: recommender analytics on Spark DataFrames.

Event log -> chronological splits -> dense dictionaries -> interaction cells
and ratings -> factor models -> unseen top-N lists -> Borda fusion ->
Precision@K / Recall@K -> seeded hyperparameter search and a run log.
"""

__version__ = "0.1.0"
