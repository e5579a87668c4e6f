"""Near-duplicate lines with a segment-partition edit join.

A line is removed where it repeats an earlier line, or one within ``THRESHOLD``
byte edits of it.  Two lines that close share, by the pigeonhole principle, at
least one of the ``THRESHOLD + 1`` segments that one of them is cut into, at
almost the same place: the segments of every line are indexed by length, number
and content, and every line probes the index with the substrings that can match
(for each length difference and segment, only the starts that the edits on
either side allow).  Pairs whose letter counts are further apart than the edits
allow are none: many lines that share most of a text are told apart by that.
Candidate pairs are confirmed by a banded bit-parallel edit distance: a band of ``2 * THRESHOLD + 2`` diagonals is one bit vector, and
each byte of the text takes a few word operations.

Everything on the path is a built-in column function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestats.llm.common import BROADCAST_ROWS, join_keys, materialize

THRESHOLD = 2        # byte edits
LEAST_BYTES = 40     # shorter lines are only compared for equality
LAST = (1 << 63) - 1  # stands for a null doc_id, behind all others
ENDS = 64            # bytes at either end that are compared before whole lines
# Letters whose counts tell lines apart before they are compared (either case).
CLASSES = ("e", "t", "a", "o", "i", "n", "s", "h", "r", "d", "lu", "cm", "fgw", "yp", "bvk", "xjqz")


def _segment(length: Column, number: int, threshold: int) -> tuple[Column, Column]:
    """0-based start and length of a segment: even parts, longer ones last."""
    parts = threshold + 1
    short = F.floor(length / parts).cast("int")
    longer = F.greatest(F.lit(0), number - (parts - length % parts)).cast("int")
    size = short + F.when(number >= parts - length % parts, 1).otherwise(0)
    return short * number + longer, size


def _key(line: Column, length: Column, number: int, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(number), length, F.substring(line, start + 1, size))


def index_keys(line: Column, length: Column, threshold: int = THRESHOLD) -> Column:
    keys = []
    for i in range(threshold + 1):
        start, size = _segment(length, i, threshold)
        keys.append(_key(line, length, i, start, size))
    return F.array(*keys)


def probe_keys(line: Column, length: Column, threshold: int = THRESHOLD,
               least: int = LEAST_BYTES) -> Column:
    """Keys of the substrings that can be a segment of a line that is as long
    or up to ``threshold`` bytes shorter."""
    keys = []
    for shorter in range(threshold + 1):
        other = length - shorter
        for i in range(threshold + 1):
            start, size = _segment(other, i, threshold)
            right = threshold - i
            for move in range(max(-i, shorter - right), min(i, shorter + right) + 1):
                key = _key(line, other, i, start + move, size)
                keys.append(F.when((other >= least) & (start + move >= 0), key))
    return F.array_compact(F.array(*keys))


def shared_keys(lines: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_BYTES) -> DataFrame:
    """``(key, probe, h)`` rows of the lines (``line``) that share a key with
    another: ``h`` is a hash that stands for the line (lines that share one are
    told apart later), ``probe`` tells a probing row from an indexed one.  A key
    of one line alone goes no further than the shuffle that finds it alone."""
    data = lines.select(F.xxhash64("line").alias("h"), F.col("line").cast("binary").alias("b"),
                        F.octet_length("line").alias("n")).where(F.col("n") >= least)

    def tagged(keys: Column, probe: bool) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(probe).alias("probe")))

    each = data.select("h", F.explode(F.concat(
        tagged(index_keys(F.col("b"), F.col("n"), threshold), False),
        tagged(probe_keys(F.col("b"), F.col("n"), threshold, least), True))).alias("k"))
    rows = each.select("k.key", "k.probe", "h").distinct()
    by_key = Window.partitionBy("key")
    return (rows.withColumn("low", F.min("h").over(by_key)).withColumn("high", F.max("h").over(by_key))
            .where(F.col("low") < F.col("high")).select("key", "probe", "h"))


def letter_counts(line: Column) -> Column:
    """How often the letters of each of ``CLASSES`` occur.  An inserted or
    deleted byte changes one count by one, a replaced byte at most two."""
    def count(letters: str) -> Column:
        return (F.length(line) - F.length(F.translate(line, letters + letters.upper(), ""))).cast("int")

    return F.array(*[count(c) for c in CLASSES])


def candidate_pairs(keys: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Distinct ``(r, s)`` pairs of the ``num`` of ``texts`` (``num``, ``h``,
    ``line``) that share a key and whose lengths and letters allow the
    threshold."""
    known = texts.select("num", "h", F.octet_length("line").alias("n"), letter_counts(F.col("line")).alias("c"))
    index = keys.where(~F.col("probe")).join(known, "h").select(
        "key", F.col("num").alias("r"), F.col("n").alias("rn"), F.col("c").alias("rc"))
    probe = keys.where("probe").join(known, "h").select(
        "key", F.col("num").alias("s"), F.col("n").alias("sn"), F.col("c").alias("sc"))
    apart = None
    for k in range(len(CLASSES)):
        here = F.abs(F.get("rc", F.lit(k)) - F.get("sc", F.lit(k)))
        apart = here if apart is None else apart + here
    # lines of one length find each other from both sides
    pair = index.join(probe, "key").where(
        (F.col("r") != F.col("s")) & (F.abs(F.col("rn") - F.col("sn")) <= threshold) & (apart <= 2 * threshold))
    return pair.select(F.least("r", "s").alias("r"), F.greatest("r", "s").alias("s")).distinct()


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _common(a: Column, b: Column, most: Column) -> Column:
    """Length of the longest common prefix of two binaries, at most ``most``:
    equal stretches of falling powers of two."""
    def step(at: Column, width: Column) -> Column:
        same = F.substring(a, at + 1, width) == F.substring(b, at + 1, width)
        return F.when((at + width <= most) & same, at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), F.lit(0), step)


def banded_distance(pattern: Column, m: Column, text: Column, n: Column, threshold: int) -> Column:
    """Edit distance of two byte arrays of lengths ``m`` and ``n``, exact up to
    ``threshold`` and larger than it otherwise.  Needs ``m > threshold`` and
    lengths that differ by at most ``threshold``.

    Bit ``k`` of a vector is the diagonal band's cell ``k`` in the column of a
    text byte: vertical differences +1 and -1 (``vp``, ``vn``) go from column to
    column.  The cell at the top of the band is followed down the diagonal to
    the last row, and then along that row.  Neighbouring cells differ by at most
    one, so once that cell is more than ``threshold + width`` no cell of the
    band can lead back to ``threshold``, and the remaining columns are passed
    over.
    """
    width = 2 * threshold + 2
    mask, diagonal = (1 << width) - 1, 1 << (width - 1)
    start = F.struct(F.lit(mask & ~((1 << (width - threshold - 1)) - 1)).alias("vp"),
                     F.lit(0).alias("vn"), F.lit(threshold).alias("d"))

    def step(s: Column, i: Column) -> Column:
        here = F.get(text, i)
        match = None
        for k in range(width):
            hit = F.when(F.get(pattern, i + (threshold - width + 1 + k)) == here, 1 << k).otherwise(0)
            match = hit if match is None else match + hit

        def column(x: Column) -> Column:
            vp, vn = s["vp"], s["vn"]
            d0 = (((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn)
                  .bitwiseAND(F.lit(mask)))

            def after(d0: Column) -> Column:
                hp = vn.bitwiseOR(F.lit(mask).bitwiseXOR(d0.bitwiseOR(vp)))
                hn = d0.bitwiseAND(vp)

                def close(h: Column) -> Column:
                    hp, hn = h["hp"], h["hn"]
                    down = F.shiftright(d0, 1)
                    behind = i - (m - threshold)        # columns since the last row was reached
                    row = F.expr("1").cast("int")
                    at = F.when(behind < 0, F.lit(0)).otherwise(
                        F.element_at(F.array(*[F.lit(1 << max(0, width - 2 - k))
                                               for k in range(2 * threshold + 1)]),
                                     F.least(behind + row, F.lit(2 * threshold + 1))))
                    change = F.when(behind < 0, F.when(d0.bitwiseAND(F.lit(diagonal)) == 0, 1)
                                    .otherwise(0)).otherwise(
                        F.when(hp.bitwiseAND(at) != 0, 1).when(hn.bitwiseAND(at) != 0, -1)
                        .otherwise(0))
                    return F.struct(
                        hn.bitwiseOR(F.lit(mask).bitwiseXOR(down.bitwiseOR(hp)))
                        .bitwiseAND(F.lit(mask)).alias("vp"),
                        down.bitwiseAND(hp).alias("vn"), (s["d"] + change).alias("d"))

                return _let(F.struct(hp.alias("hp"), hn.alias("hn")), close)

            return _let(d0, after)

        return F.when(s["d"] > threshold + width, s).otherwise(_let(match, column))

    columns = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(columns, start, step, lambda s: s["d"])


def _ends_differ(x: Column, y: Column, m: Column, n: Column, threshold: int) -> Column:
    """Whether the ends alone show that two texts of ``m`` and ``n`` characters
    are more than ``threshold`` edits apart: within it, the first (or last)
    ``ENDS`` characters of one are within it of the first ``j`` of the other,
    for some ``j`` that is at most ``threshold`` away from ``ENDS``."""
    def none(head, other) -> Column:
        tests = [F.levenshtein(head, other(ENDS + move), threshold) < 0
                 for move in range(-threshold, threshold + 1)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def last(text: Column, size: Column, k: int) -> Column:
        return F.substring(text, F.greatest(size - k, F.lit(0)) + 1, F.lit(k))

    return (none(F.substring(x, 1, ENDS), lambda k: F.substring(y, 1, k))
            | none(last(x, m, ENDS), lambda k: last(y, n, k)))


def within(a: Column, b: Column, threshold: int = THRESHOLD) -> Column:
    """Whether two binaries are within ``threshold`` edits.  Equal ends don't
    change the distance and are left out, but for ``threshold + 1`` bytes.
    Most pairs further apart then show it at the ends of what is left."""
    na, nb = F.octet_length(a), F.octet_length(b)

    def middle(p: Column) -> Column:
        cut = F.greatest(p - (threshold + 1), F.lit(0))
        ra, rb = F.reverse(F.decode(F.substring(a, cut + 1, na), "ISO-8859-1")), \
            F.reverse(F.decode(F.substring(b, cut + 1, nb), "ISO-8859-1"))

        def judge(r: Column) -> Column:
            x, y, m, n = r["x"], r["y"], r["m"], r["n"]
            tail = _common(x, y, F.least(m, n) - F.least(F.least(m, n), F.lit(threshold + 1)))
            return _let(F.struct(
                F.decode(F.substring(x, tail + 1, m), "ISO-8859-1").alias("x"), (m - tail).alias("m"),
                F.decode(F.substring(y, tail + 1, n), "ISO-8859-1").alias("y"), (n - tail).alias("n")),
                rest)

        def rest(r: Column) -> Column:
            x, y, m, n = r["x"], r["y"], r["m"], r["n"]
            # the arrays are bound once: in the recurrence they are read per byte
            banded = _let(F.struct(F.split(x, "").alias("x"), F.split(y, "").alias("y")),
                          lambda c: banded_distance(c["x"], m, c["y"], n, threshold) <= threshold)
            return F.when(_ends_differ(x, y, m, n, threshold), F.lit(False)).otherwise(banded)

        return _let(F.struct(F.encode(ra, "ISO-8859-1").alias("x"),
                             F.encode(rb, "ISO-8859-1").alias("y"),
                             (na - cut).alias("m"), (nb - cut).alias("n")), judge)

    return F.when(F.abs(na - nb) > threshold, F.lit(False)).otherwise(
        _let(_common(a, b, F.least(na, nb)), middle))


def _line_hash(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2")]


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD,
                  least: int = LEAST_BYTES) -> DataFrame:
    """``(ord, pos, near)`` of every removed line of ``docs`` (``ord``, ``text``):
    ``near`` tells a line with a near one before it from a plain repetition."""
    lines = docs.select("ord", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.where(F.col("line").rlike(r"\S"))
    place = F.struct("ord", "pos")
    long = lines.where(F.octet_length("line") >= least)
    keys = materialize(shared_keys(long, threshold, least), "line-keys")
    # the lines that share a key, with the place of their first occurrence
    held = materialize(keys.select("h").distinct(), "line-hashes")
    texts = materialize(
        join_keys(long.withColumn("h", F.xxhash64("line")), held, ["h"])
        .groupBy("h", "line").agg(F.min(place).alias("id"))
        .withColumn("num", F.monotonically_increasing_id()), "line-texts")
    pairs = materialize(candidate_pairs(keys, texts, threshold), "line-pairs")
    a = texts.select(F.col("num").alias("r"), F.col("line").cast("binary").alias("a"), F.col("id").alias("ra"))
    b = texts.select(F.col("num").alias("s"), F.col("line").cast("binary").alias("b"), F.col("id").alias("sb"))
    later = (pairs.join(a, "r").join(b, "s").where(within(F.col("a"), F.col("b"), threshold))
             .select(F.greatest("ra", "sb").alias("id")).distinct())
    near = texts.join(later, "id").select(*_line_hash(F.col("line")), "id",
                                          F.lit(True).alias("near"))

    hashed = lines.select("ord", "pos", *_line_hash(F.col("line")))
    repeated = (hashed.groupBy("h1", "h2").agg(F.min(place).alias("id"), F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1).select("h1", "h2", "id", F.lit(False).alias("near")))
    judged = materialize(near.union(repeated).groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.max("near").alias("near")), "judged-lines")
    return join_keys(hashed, judged, ["h1", "h2"], "inner").where(
        F.col("near") | (F.struct("ord", "pos") != F.col("id"))).select("ord", "pos", "near")


def _identity(docs: DataFrame) -> Column:
    """What tells a row from the others: its place in the order, then 128 bits
    that stand for all its columns."""
    row = [F.col(c) for c in docs.columns]
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("n"),
                    F.xxhash64(*row).alias("h1"), F.xxhash64(*row, F.lit(1)).alias("h2"))


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_BYTES) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any other columns) without the lines
    that repeat earlier ones: all columns, with ``text`` reduced, and
    ``n_lines``, ``n_removed`` and ``n_near``.

    Lines end at a line feed; "earlier" is by ``doc_id``, then by place.  A line
    is judged on the input: an occurrence goes if an equal line occurs earlier,
    or if some line within ``threshold`` byte edits occurs earlier than its own
    first occurrence (both lines of at least ``least`` bytes).

    * A null or empty text has no line to remove and stays as it is; lines
      without visible characters stay too.
    * Every row is a document of its own.  Those with a null ``doc_id`` come
      last; they, and different rows that share a ``doc_id``, follow each other
      by a hash of all columns.
    * Rows that have a ``doc_id`` and are equal in all columns are one document
      read several times: a line at the place of its first occurrence stays in
      each of them.  Equal rows without a ``doc_id`` are several documents: the
      lines of all but one are repetitions.
    * Input columns named like one of the counts are replaced.
    * An empty table gives an empty result.
    """
    order = _identity(docs)
    gone = materialize(
        removed_lines(docs.select(order.alias("ord"), F.col("text")), threshold, least)
        .groupBy("ord").agg(F.collect_set("pos").alias("_gone"),
                            F.collect_set(F.when(F.col("near"), F.col("pos"))).alias("_near")),
        "removed-lines")
    if (gone.agg(F.sum(F.size("_gone"))).first()[0] or 0) <= 4 * BROADCAST_ROWS:
        gone = F.broadcast(gone)
    equal = materialize(docs.where(F.col("doc_id").isNull()).groupBy(order.alias("ord"))
                        .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1), "equal-rows")
    # the input's columns travel as one, so their names clash with nothing here
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
                       order.alias("ord"), F.split("text", "\n", -1).alias("_lines"))
    copy = F.lit(0).cast("long").alias("_copy")
    if equal.isEmpty():
        rows = rows.select("*", copy)
    else:
        several = join_keys(rows, equal, ["ord"], "inner").groupBy("ord").agg(
            F.any_value("_row").alias("_row"), F.any_value("_lines").alias("_lines"),
            F.any_value("_n").alias("_n"))
        rows = join_keys(rows, equal, ["ord"], "leftanti").select("_row", "ord", "_lines", copy).union(
            several.select("_row", "ord", "_lines",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    again = F.filter(places, lambda i: F.get(F.col("_lines"), i).rlike(r"\S"))
    rows = rows.join(gone, "ord", "left").withColumn(
        "_gone", F.when(F.col("_copy") > 0, again).otherwise(F.col("_gone")))
    kept = F.array_except(places, F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n"))
    counts = {"n_lines": "_lines", "n_removed": "_gone", "n_near": "_near"}
    joined = rows.select(
        "_row", text.alias("_text"),
        *[F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long").alias(f"_{n}")
          for n, c in counts.items()])
    return joined.select(
        *[(F.col("_text") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns if c not in counts],
        *[F.col(f"_{n}").alias(n) for n in counts])
