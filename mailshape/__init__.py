"""mailshape: analysis and classification of large mail corpora on Spark.

Sub-packages
------------
``sources``    readers for mail CSV files and raw mail folders, mail views, writers
``functions``  pure ``Column`` expressions: cleaning, token counts, structural features
``operators``  DataFrame -> DataFrame steps: preparation, profiling, vectorising, models
``plans``      whole runs put together from the operators, and the query registry
"""

__version__ = "0.1.0"
