from gamestats.plans.catalog import GAME_QUERIES, RATING_QUERIES, star_queries  # noqa: F401
from gamestats.plans.oracle import oracle_sql  # noqa: F401
