"""Keyed statistics over archives of chess games, and over any table of the
same shape, as Spark DataFrame jobs.

Main entry points:

* ``gamestats.sources`` - ``read_games_csv`` / ``read_games_lines`` /
  ``read_games_parquet`` / ``read_ratings_tsv``; ``measured_games_table``
  (games files measured once into a Parquet table); ``games_table`` (the
  measured games view over ``orders`` + ``lineitem``, written once).
* ``gamestats.operators`` - ``measure_games`` and the generic keyed,
  ranking and best-of-group operators.
* ``gamestats.plans.catalog`` - the named queries; ``gamestats.plans.oracle``
  - their SQL for DuckDB.
* ``gamestats.streaming`` - the same statistics over files as they arrive.
* ``python -m gamestats`` - run a query from files to files.
"""

__version__ = "0.1.0"
