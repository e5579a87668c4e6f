"""Games and ratings views over the driver's star-schema tables.

Games come from ``orders`` (one game per order) and ``lineitem`` (one move per
line item).  A line item stands for the move fragment
``"<l_linenumber>. <token>"``; the game's move text would be its fragments in
line order, joined by spaces.

The view never builds that text.  The measures only count characters and look
for patterns that contain no space, so they are additive over space-joined
fragments (see ``gamestats.functions.measures``): each line item is measured on
its own and the counts are summed per order.  That is a plain partial +
final aggregation, so an order with any number of line items costs one small
row per map task in the shuffle, and no task ever holds an order's lines
together.  The aggregate comes out hash-partitioned on the order key, which the
join to ``orders`` reuses: only ``orders`` is shuffled for the join.

The ``numbered`` move count is the one pattern with a space in it; it stays
additive here because every fragment is exactly one ``"<n>. "`` move number
followed by a token that never ends in a dot.

``with_text=True`` additionally builds the text (ordered collect per order);
it is meant for exporting small samples, not for the catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.functions import measures as M
from gamestats.operators.measured import finish_games


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the games view (the driver's documented derivation).
RESULT_OF_STATUS = {"F": "1-0", "O": "0-1", "P": "1/2-1/2"}
WHITE_ELO_MISSING_EVERY = 97
ELO_BASE, ELO_SPAN, WHITE_ELO_STEP, BLACK_ELO_STEP = 800, 2100, 37, 53
ECO_LETTER, ECO_MODULUS, OPENING_MODULUS = "C", 40, 7
TOKEN_RETURNED = "Nxe5"
TOKEN_A_BIG = "Rxe8++"
BIG_QUANTITY = 45
TOKEN_A = "Qh5+"
TOKEN_OPEN = "O-O"
TOKEN_OTHER = "e4"


def move_token() -> Column:
    flag, status, qty = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    return (F.when(flag == "R", F.lit(TOKEN_RETURNED))
            .when((flag == "A") & (qty >= BIG_QUANTITY), F.lit(TOKEN_A_BIG))
            .when(flag == "A", F.lit(TOKEN_A))
            .when(status == "O", F.lit(TOKEN_OPEN))
            .otherwise(F.lit(TOKEN_OTHER)))


def move_fragment() -> Column:
    return F.concat(F.col("l_linenumber").cast("string"), F.lit(". "), move_token())


def _result(status: Column) -> Column:
    expr = None
    for code, res in RESULT_OF_STATUS.items():
        expr = (F.when if expr is None else expr.when)(status == code, F.lit(res))
    return expr


# What the fragments of an order are sorted by in its text.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "_frag")


def _per_order_measures(lineitem: DataFrame, moves_mode: str, with_text: bool = False) -> DataFrame:
    # The fragment is projected once; it is referenced by every measure, so
    # Catalyst keeps the projection instead of inlining the string build into
    # each aggregate input.
    frag = F.col("_frag")
    aggs = [F.min("l_suppkey").alias("black_key"),
            F.sum(M.moves(frag, moves_mode)).alias("moves"),
            F.sum(M.captures(frag)).alias("captures"),
            F.sum(M.char_count(frag, M.CHECK_MARK)).alias("plus_marks"),
            F.max(M.has_double_plus(frag)).alias("double_plus"),
            F.max(M.castled(frag, "notation")).alias("castled"),
            F.max(M.castled(frag, "dash")).alias("castled_dash")]
    lines = lineitem.withColumn("_frag", move_fragment())
    if not with_text:
        return lines.select("l_orderkey", "l_suppkey", "_frag").groupBy("l_orderkey").agg(*aggs)
    # The lines are dealt by order as plain rows, once for all aggregates: lists
    # begun in the map tasks save no rows, but each of those tasks would sort,
    # and spill, every line that it reads.
    ordered = F.array_sort(F.collect_list(F.struct(*LINE_ORDER)))
    text = F.array_join(F.transform(ordered, lambda s: s["_frag"]), " ")
    return (lines.select("l_orderkey", *LINE_ORDER).repartition("l_orderkey")
            .groupBy("l_orderkey").agg(*aggs, text.alias("an")))


def games_from_star(spark: SparkSession, sf_dir: str, moves_mode: str = "dots",
                    with_text: bool = False) -> DataFrame:
    """Measured games (see ``gamestats.operators.measured``) from orders + lineitem."""
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")
    per_order = _per_order_measures(lineitem, moves_mode, with_text)

    # Both sides are as large as the orders table, so the join is a sort-merge
    # join at every scale (never a broadcast of a side that grows with the
    # data).  The aggregate side is already hash-partitioned on the order key,
    # so only orders is shuffled for it.
    per_order = per_order.hint("merge")
    g = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left")
    cust, okey, supp = F.col("o_custkey"), F.col("o_orderkey"), F.col("black_key")
    zero = F.lit(0)
    cols = {
        "id": okey,
        "event": F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")),
        "white": F.concat(F.lit("c"), cust.cast("string")),
        "black": F.concat(F.lit("s"), supp.cast("string")),
        "result": _result(F.col("o_orderstatus")),
        "white_elo": F.when(cust % WHITE_ELO_MISSING_EVERY == 0, F.lit("?"))
                      .otherwise((ELO_BASE + (cust * WHITE_ELO_STEP) % ELO_SPAN).cast("string")),
        "black_elo": (ELO_BASE + (supp * BLACK_ELO_STEP) % ELO_SPAN).cast("string"),
        "eco": F.concat(F.lit(ECO_LETTER),
                        F.lpad((okey % ECO_MODULUS).cast("string"), 2, "0")),
        "opening": F.concat(F.lit("Opening "), (okey % OPENING_MODULUS).cast("string")),
        "time_control": F.lit(None).cast("string"),
        "termination": F.lit(None).cast("string"),
    }
    if with_text:
        cols["an"] = F.coalesce(F.col("an"), F.lit(""))
    status = F.col("o_orderstatus")
    cols.update({
        "moves": F.coalesce(F.col("moves"), zero.cast("long")),
        "captures": F.coalesce(F.col("captures"), zero.cast("long")),
        "checks": F.coalesce(F.col("plus_marks") - F.col("double_plus"), zero.cast("long")),
        "castled": F.coalesce(F.col("castled"), zero),
        "castled_dash": F.coalesce(F.col("castled_dash"), zero),
        "draw": M.draw(_result(status)),
        "white_win": M.white_win(_result(status)),
        "black_win": M.black_win(_result(status)),
    })
    return finish_games(g.select(*[c.alias(n) for n, c in cols.items()]))


def games_table(spark: SparkSession, sf_dir: str, moves_mode: str = "dots") -> DataFrame:
    """The measured-games view written once (see ``gamestats.sources.derived``)
    and read back: what the catalogue queries read."""
    import sys

    from gamestats.functions import bands, measures
    from gamestats.operators import measured
    from gamestats.sources.derived import definition_fingerprint, derived_table

    d = sf_dir.rstrip("/")
    definition = definition_fingerprint(sys.modules[__name__], measures, bands, measured)
    return derived_table(spark, f"games-{moves_mode}",
                         [f"{d}/orders.parquet", f"{d}/lineitem.parquet"],
                         lambda: games_from_star(spark, d, moves_mode), definition)


def ratings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings view over ``events``: series = user, episode = event id,
    rating = value, type = event type."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("series"),
        F.col("event_id").cast("string").alias("episode"),
        F.col("value").alias("rating"),
        F.col("event_type").alias("type"),
    )


def rated_items_table(spark: SparkSession, sf_dir: str, item_type: str) -> DataFrame:
    """The rated items of one type from the events view, written once (see
    ``gamestats.sources.derived``): the rating queries then read only the kept
    items instead of filtering the whole events table each time."""
    import sys

    from gamestats.operators import best
    from gamestats.sources.derived import definition_fingerprint, derived_table

    d = sf_dir.rstrip("/")
    definition = definition_fingerprint(sys.modules[__name__], best)
    return derived_table(spark, f"rated-{item_type}", [f"{d}/events.parquet"],
                         lambda: best.rated_items(ratings_from_events(spark, d), item_type),
                         definition)


def rated_summary_table(spark: SparkSession, sf_dir: str, item_type: str) -> DataFrame:
    """Mean and maximum per series of the rated items, one small row each,
    written once (see ``gamestats.sources.derived``): a query that needs them
    beside the items reads the items only once."""
    import sys

    from gamestats.functions import exact as exact_functions
    from gamestats.operators import best, exact
    from gamestats.sources.derived import definition_fingerprint, derived_table

    d = sf_dir.rstrip("/")
    definition = definition_fingerprint(sys.modules[__name__], best, exact, exact_functions)
    return derived_table(spark, f"rated-summary-{item_type}", [f"{d}/events.parquet"],
                         lambda: best.summarise_group(rated_items_table(spark, d, item_type),
                                                      "series", "rating"), definition)
