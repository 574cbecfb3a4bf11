"""tessera: tabular feature engineering and model evaluation on Spark DataFrames.

Sub-packages
------------
sources    table loading, CSV scan/sink, fixture views
functions  column-expression helpers (scalars, arrays)
operators  DataFrame -> DataFrame operators (prep, relate, agg, window, ids,
           encode, image, model, metric)
plans      end-to-end flows and the registered query catalog
streaming  running the stateless operators on a streaming DataFrame
"""

__version__ = "0.1.0"
