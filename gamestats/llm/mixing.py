"""Mixing sources to target weights with pivotal dependent rounding.

A source's target in words divided by its size is the number of copies that
each of its documents should get on average.  The whole part is given to every
document; the fractional parts are rounded together: two documents are paired,
and words are moved at random from one to the other until one of them has a
whole number of copies, with odds that keep every expectation.  The words
taken from the pair don't change, so after all pairs a source is off its
target by less than the one document left over.

The pairing is a reduction tree: documents are dealt by hash into blocks of
about ``BLOCK`` per source, each block is folded by a built-in array function
down to one open document, and the open documents of ``BLOCK`` neighbouring
blocks meet at the next level.  No task holds more than a block of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import WORD_PATTERN, join_keys, materialize, with_global_rank

BLOCK = 256
SEED = 2024
WEIGHTS = (3, 1, 2)       # fixed values: repeating over the sources in order
SHARE = 1.5               # of all sizes
MOST = 2                  # times a source's own size
_UNIT = "struct<draw:bigint,doc_id:bigint,tag:bigint,size:bigint,whole:int,part:double>"
_DONE = "array<struct<doc_id:bigint,tag:bigint,size:bigint,copies:int>>"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def source_targets(units: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` per source of ``(source, size)`` rows.

    Targets share ``SHARE`` of all sizes by weight.  Shares above ``MOST``
    times a source's size stop there and the excess is shared again by weight,
    until none is above; only sums go to the driver.
    """
    sums = materialize(units.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = with_global_rank(sums, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    table = materialize(ranked.select("source", "source_size", weight.alias("weight")), "weights")
    most = MOST * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        above = F.col("weight") * F.lit(level) > most
        row = table.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("stopped"),
            F.sum(F.when(above, most).otherwise(0)).alias("full"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open")).first()
        if row["stopped"] == stopped or not row["open"]:
            break
        stopped = row["stopped"]
        level = (SHARE * total - row["full"]) / row["open"]
    target = F.least(F.col("weight") * F.lit(level), most.cast("double"))
    return materialize(table.select("source", "source_size", target.alias("target")), "targets")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _coin(a: Column, b: Column) -> Column:
    bits = F.xxhash64(a["draw"], a["doc_id"], b["draw"], b["doc_id"], F.lit(SEED))
    return bits.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(float(1 << 53))


def _with_part(unit: Column, part: Column) -> Column:
    return F.struct(*[(part if n == "part" else unit[n]).alias(n)
                      for n in ("draw", "doc_id", "tag", "size", "whole", "part")])


def _closed(unit: Column, extra: Column) -> Column:
    return F.struct(unit["doc_id"].alias("doc_id"), unit["tag"].alias("tag"),
                    unit["size"].alias("size"),
                    (unit["whole"] + extra).cast("int").alias("copies"))


def _meet(state: Column, b: Column) -> Column:
    """One meeting: move words between the open document and the next."""
    a = state["open"]
    words = lambda u: u["part"] * u["size"]                    # noqa: E731 - taken so far
    room = lambda u: (F.lit(1.0) - u["part"]) * u["size"]      # noqa: E731 - not yet taken

    def moved(m: Column) -> Column:
        up, down = m["up"], m["down"]      # words that can go from b to a, from a to b
        to_a = _coin(a, b) * (up + down) < down
        # to a: a becomes 1 (the rest of b stays open) or b becomes 0
        first = F.when(room(a) <= words(b), F.struct(
            _closed(a, F.lit(1)).alias("done"),
            _with_part(b, (words(b) - up) / b["size"]).alias("open"))).otherwise(F.struct(
                _closed(b, F.lit(0)).alias("done"),
                _with_part(a, a["part"] + up / a["size"]).alias("open")))
        # to b: a becomes 0 or b becomes 1
        second = F.when(words(a) <= room(b), F.struct(
            _closed(a, F.lit(0)).alias("done"),
            _with_part(b, b["part"] + down / b["size"]).alias("open"))).otherwise(F.struct(
                _closed(b, F.lit(1)).alias("done"),
                _with_part(a, (words(a) - down) / a["size"]).alias("open")))
        return F.when(to_a, first).otherwise(second)

    move = F.struct(F.least(room(a), words(b)).alias("up"), F.least(words(a), room(b)).alias("down"))
    met = _let(_let(move, moved), lambda r: F.struct(
        _with_part(r["open"], F.greatest(F.lit(0.0), F.least(F.lit(1.0), r["open"]["part"])))
        .alias("open"),
        F.concat(state["done"], F.array(r["done"])).alias("done")))
    begun = F.struct(b.cast(_UNIT).alias("open"), state["done"].alias("done"))
    return F.when(a.isNull(), begun).otherwise(met)


def _fold(units: Column) -> Column:
    start = F.struct(F.lit(None).cast(_UNIT).alias("open"), F.array().cast(_DONE).alias("done"))
    return F.aggregate(F.array_sort(units), start, _meet)


def pivotal_rounding(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(source, doc_id, tag, size, copies)`` of ``(source, unit)`` rows."""
    n = units.count()
    blocks = max(1, math.ceil(n / block))
    level = units.select("source", "unit", F.pmod(F.col("unit.draw"), F.lit(blocks)).alias("block"))
    done = None
    while True:
        folded = materialize(
            level.groupBy("source", "block").agg(_fold(F.collect_list("unit")).alias("r"))
            .select("source", "block", "r.open", "r.done"), "rounding")
        part = folded.select("source", F.explode("done").alias("d"))
        done = part if done is None else done.union(part)
        if blocks == 1:
            break
        blocks = math.ceil(blocks / block)
        level = folded.select("source", F.col("open").alias("unit"),
                              F.floor(F.col("block") / block).alias("block"))
    last = F.col("open")
    up = (_coin(last, last) < last["part"]).cast("int")
    rest = folded.select("source", _closed(last, up).alias("d"))
    return done.union(rest).select("source", "d.doc_id", "d.tag", "d.size", "d.copies")


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text`` and ``source``; other columns
    only tell repeated rows apart): ``(doc_id, size, source_size, target,
    taken, copies, source, tag)``, where ``taken`` is ``copies * size``.

    * A null text has size 0; a null source is a source of its own, last in order.
    * A document without words takes no part in the pairing: it gets the whole
      part of its source's rate, and one more by its own hash.
    * Rows that repeat are rounded one by one; runs on equal rows agree.
    * An empty table gives an empty result.
    """
    tag = F.xxhash64(*[F.col(c) for c in docs.columns])
    units = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), tag.alias("tag"),
        word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(units)
    # null sources join too
    named = targets.select(F.coalesce("source", F.lit("")).alias("_s"),
                           F.col("source").isNull().alias("_none"), "source_size", "target")

    def with_target(df: DataFrame) -> DataFrame:
        df = df.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn(
            "_none", F.col("source").isNull())
        return join_keys(df, named, ["_s", "_none"], "inner").drop("_s", "_none")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = F.xxhash64("doc_id", "tag", F.lit(SEED))
    rated = with_target(units).withColumn("rate", rate).select(
        "source", F.struct(
            draw.alias("draw"), "doc_id", "tag", "size",
            F.floor("rate").cast("int").alias("whole"),
            (F.col("rate") - F.floor("rate")).alias("part")).alias("unit"))
    rated = materialize(rated, "rated")
    paired = (F.col("unit.part") > 0) & (F.col("unit.size") > 0)
    rounded = pivotal_rounding(rated.where(paired))
    u = F.col("unit")
    alone = rated.where(~paired).select(
        "source", "unit.doc_id", "unit.tag", "unit.size",
        (u["whole"] + (_coin(u, u) < u["part"]).cast("int")).alias("copies"))
    return with_target(rounded.union(alone)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", "tag")
