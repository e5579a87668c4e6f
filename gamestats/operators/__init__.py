from gamestats.operators.best import (  # noqa: F401
    all_names, best_names, merged, rated_items, summarise_group)
from gamestats.operators.keyed import (  # noqa: F401
    keyed_count, keyed_mean, keyed_pct, keyed_ratio, keyed_sum,
    mean_of, multi_keyed, pct_of)
from gamestats.operators.filters import with_result  # noqa: F401
from gamestats.operators.measured import finish_games, measure_games  # noqa: F401
from gamestats.operators.ranking import sample_k, sort_by_key, top_k  # noqa: F401
