"""Join shapes beyond the plain equi join. Small sides become broadcasts by their measured size (adaptive
execution); nothing here forces one on a table that grows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import _c
from .windows import _cols, running_sum, split_window


def null_safe_join(a: DataFrame, b: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join in which NULL keys match each other; the key columns appear once."""
    keys = _cols(keys)
    right = b.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    joined = a.join(right, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys], how)
    if how in ("left_semi", "left_anti", "leftsemi", "leftanti"):
        return joined
    if how.startswith(("right", "full")):
        joined = joined.withColumns({k: F.coalesce(k, f"__r_{k}") for k in keys})
    return joined.drop(*[f"__r_{k}" for k in keys])


def full_join_zero_fill(a: DataFrame, b: DataFrame, keys, measures: list[str]) -> DataFrame:
    """Full outer join on coalesced keys; missing measures become 0."""
    return a.join(b, _cols(keys), "full_outer").fillna(0, subset=measures)


def full_join_many(frames: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """N per-key aggregates side by side, one column per frame, missing as 0.

    One union and one aggregation instead of a chain of full outer joins; each key meets all frames at once.
    """
    parts = [
        f.select(F.col(key), *[F.col(value).alias(n) if n == name else F.lit(None).cast(f.schema[value].dataType).alias(n)
                               for n in frames])
        for name, f in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in frames])


def day_over_day(df: DataFrame, keys, date_col: str, value: str, day: Column, before: Column) -> DataFrame:
    """Today's and the earlier day's value of every key seen on either day, from one scan of two days."""
    two = df.filter(F.col(date_col).isin(day, before))
    is_day = F.col(date_col) == day
    return two.groupBy(*_cols(keys)).agg(
        F.max(F.when(is_day, F.col(value))).alias(f"{value}_today"),
        F.max(F.when(~is_day, F.col(value))).alias(f"{value}_before"),
    )


def either_endpoint_in(df: DataFrame, cols: list[str], members: DataFrame, member: str, row_key: list[str]) -> DataFrame:
    """Rows of which any endpoint column is a member: endpoints are exploded, matched once, rows kept once."""
    keys = members.select(F.col(member).alias("__m")).filter(F.col(member).isNotNull()).distinct()
    ends = df.select(*row_key, F.explode(F.array_distinct(F.array(*cols))).alias("__m"))
    hit = ends.join(keys, "__m", "left_semi").select(*row_key).distinct()
    return df.join(hit, row_key, "left_semi")


def not_in(a: DataFrame, b: DataFrame, key: str, other: str | None = None, null_aware: bool = True) -> DataFrame:
    """``key NOT IN (SELECT other FROM b)``.

    With SQL NULL rules: a NULL in b empties the result, and a NULL key survives only an empty b. The two facts
    about b are scalar subqueries, so the join itself is an ordinary distributed anti join.
    """
    other = other or key
    vals = b.select(F.col(other).alias("__v"))
    out = a.join(vals.filter("__v IS NOT NULL").distinct(), F.col(key) == F.col("__v"), "left_anti")
    if not null_aware:
        return out
    stats = vals.agg(F.count("*").alias("n"), F.count("__v").alias("known"))
    empty = stats.select(F.col("n") == 0).scalar()
    has_null = stats.select(F.col("n") > F.col("known")).scalar()
    return out.filter(empty | (~has_null & F.col(key).isNotNull()))


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Equality on all columns of the same name."""
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("no common columns")
    return a.join(b, common, how)


def asof_validity_join(events: DataFrame, versions: DataFrame, key: str, ts: str, start: str, attrs: list[str],
                       tie: str, bucket: Column | None, how: str = "inner") -> DataFrame:
    """Each event with the version of its key whose open interval (start, next start) holds the event.

    Both bounds are exclusive, so an event at the very start of a version matches none. Versions and events
    are put on one time line and the latest version is carried forward: no row pairs, and with a ``bucket``
    of the time no key sits in one task. ``bucket`` is an expression over the column ``ts``.
    """
    version = F.struct(F.col(start).alias("start"), *[F.col(a) for a in attrs])
    line = (
        events.withColumns({"__kind": F.lit(1), "__tie": F.col(tie).cast("string")})
        .unionByName(
            versions.select(F.col(key), F.col(start).alias(ts), F.lit(0).alias("__kind"),
                            F.lit(None).cast("string").alias("__tie"), version.alias("__version")),
            allowMissingColumns=True,
        )
    )
    seen = split_window(line, [key], [ts, "__kind", "__tie"], bucket, {"__seen": ("last", "__version")}).filter("__kind = 1")
    valid = F.when(F.col("__seen.start") < F.col(ts), F.col("__seen"))
    out = seen.withColumn("__seen", valid).select(
        *events.columns, F.col("__seen.start").alias("valid_from"), *[F.col(f"__seen.{a}").alias(a) for a in attrs]
    )
    return out if how == "left" else out.filter(F.col("valid_from").isNotNull())


def _as_number(c: Column, kind: str) -> Column:
    """Dates as days, timestamps as microseconds, whole numbers as they are."""
    if kind == "date":
        return F.unix_date(c).cast("bigint")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")
    raise TypeError(f"a range join needs dates, timestamps or whole numbers, not {kind}")


def range_blocks(lo: Column, hi: Column, step: int, levels: int) -> Column:
    """The aligned blocks that make up lo..hi exactly: an array of ``(level, block)``, a block of level L being 2^(step L) long.

    From each end the blocks that do not fill a block of the next level are taken, then the rest goes up a level; so
    there are at most 2 (2^step - 1) blocks per level, however long the range is.
    """
    width = 2**step

    def climb(s: Column, level: Column) -> Column:
        floor = lambda x: F.shiftleft(F.shiftright(x, step), step)
        up, down = floor(s["a"] + (width - 1)), floor(s["b"] + 1)  # where the next level's blocks start and stop
        last = (up >= down) | (level == levels - 1)  # nothing left for the next level
        first_end = F.when(last, s["b"]).otherwise(up - 1)
        blocks = lambda a, b: F.when(a <= b, F.transform(F.sequence(a, b), lambda x: F.struct(level.alias("level"), x.alias("block"))))
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        made = F.concat(s["out"], F.coalesce(blocks(s["a"], first_end), none), F.when(last, none).otherwise(F.coalesce(blocks(down, s["b"]), none)))
        a, b = F.when(last, F.lit(1)).otherwise(F.shiftright(up, step)), F.when(last, F.lit(0)).otherwise(F.shiftright(down, step) - 1)
        step_on = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), made.alias("out"))
        return F.when(s["a"] <= s["b"], step_on).otherwise(s)

    start = F.struct(lo.cast("bigint").alias("a"), hi.cast("bigint").alias("b"), F.array().cast("array<struct<level:int,block:bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), start, climb, lambda s: s["out"])


FEW_BLOCKS = 100_000  # blocks of ranges up to which they are broadcast; their number is counted, not estimated


def range_totals(placed: DataFrame, bounds: DataFrame, cols: list[str], totals: dict[str, str | Column]) -> DataFrame:
    """Per range with rows in it: their number ``n`` and the named sums, exactly, without any pair of row and range.

    ``placed`` has a column ``__at``, ``bounds`` has ``__lo`` and ``__hi``. Rows are summed per value and put on one line
    with the ends of the ranges; the total of a range is the running sum at its end less the one before its start.
    Ranges equal in all of ``cols`` are one row, which holds the totals of all of them.
    """
    kinds = placed.select(*[_c(c).alias(name) for name, c in totals.items()]).schema
    exact = {}
    for f in kinds:
        kind = f.dataType.simpleString()
        if kind not in ("tinyint", "smallint", "int", "bigint") and not kind.startswith("decimal"):
            raise TypeError(f"totals of ranges need whole numbers or decimals, not {kind}")
        exact[f.name] = f"decimal(28,{f.dataType.scale if kind.startswith('decimal') else 0})"
    made = placed.groupBy("__at").agg(
        F.count("*").alias("__n"), *[x for name, c in totals.items() for x in (F.coalesce(F.sum(_c(c).cast(exact[name])), F.lit(0)).alias(f"__s_{name}"), F.count(_c(c)).alias(f"__c_{name}"))])
    steps = [c for c in made.columns if c != "__at"]
    kept = bounds.filter("__lo <= __hi")
    ends = F.array(*[F.struct(F.col(c).alias("__at"), F.lit(k).alias("__kind")) for c, k in (("__lo", -1), ("__hi", 1))])  # before and after the rows of a value
    points = kept.select(F.inline(ends)).distinct()
    line = made.withColumn("__kind", F.lit(0)).unionByName(points, allowMissingColumns=True).filter("__at IS NOT NULL")
    so_far = running_sum(line, [], ["__at", "__kind"], {f"__t{i}": F.coalesce(F.col(c), F.lit(0)) for i, c in enumerate(steps)}).filter("__kind <> 0")
    sums = kept.select(*cols, F.inline(ends)).join(so_far.select("__at", "__kind", *[f"__t{i}" for i in range(len(steps))]), ["__at", "__kind"])
    both = sums.groupBy(*cols).agg(*[F.sum(F.col("__kind") * F.col(f"__t{i}")).alias(c) for i, c in enumerate(steps)]).filter("__n > 0")
    out = {f.name: F.when(F.col(f"__c_{f.name}") > 0, F.col(f"__s_{f.name}")).cast(placed.agg(F.sum(_c(totals[f.name])).alias("s")).schema["s"].dataType) for f in kinds}
    return both.select(*cols, F.col("__n").alias("n"), *[c.alias(name) for name, c in out.items()])


def range_join(df: DataFrame, ranges: DataFrame, col: str, lo: str, hi: str, how: str = "inner", dates: DataFrame | None = None, step: int = 4,
               totals: dict[str, str | Column] | None = None) -> DataFrame:
    """Rows whose date, timestamp or whole number lies between two bounds (both included); a NULL bound is open.

    Both sides meet in an equi join on aligned blocks: a range becomes a few blocks per level, a row looks up the one
    block of each level that it lies in, so a range of a second and one of a century cost about the same. ``step`` is
    the number of bits between two levels: a smaller one means fewer blocks per range and more lookups per row. Ranges
    are first cut to the span of values that occur; ``dates`` may name a cheaper frame with the same column that covers
    it. Levels that no range uses are not looked up (a list of 64 numbers at most). ``how`` is inner or left; for a left
    join the values are matched once each. With ``totals`` (name -> whole number or decimal of ``df``) an inner join gives
    only the number of rows and these sums per range, at a cost that does not follow the number of pairs (``range_totals``).
    """
    if totals is not None and how != "inner":
        raise ValueError("totals need an inner join")
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    kind = df.schema[col].dataType.simpleString()
    number = _as_number(F.col(col), kind)
    ends = (df if dates is None else dates).agg(F.min(number).alias("a"), F.max(number).alias("b"))
    span = ends.first()
    first, last = span["a"] or 0, span["b"] if span["b"] is not None else -1
    levels = max(1, -(-max(1, last - first + 1).bit_length() // step))
    bounds = ranges.withColumns({
        "__lo": F.greatest(_as_number(F.col(lo), ranges.schema[lo].dataType.simpleString()), F.lit(first)) - first,
        "__hi": F.least(_as_number(F.col(hi), ranges.schema[hi].dataType.simpleString()), F.lit(last)) - first,
    })
    if totals is not None:
        return range_totals(df.filter(F.col(col).isNotNull()).withColumn("__at", number - first), bounds, ranges.columns, totals)
    cut = bounds.filter("__lo <= __hi").withColumn("__b", F.explode(range_blocks(F.col("__lo"), F.col("__hi"), step, levels)))
    blocks = cut.select(*ranges.columns, F.col("__b.level").alias("__level"), F.col("__b.block").alias("__block"))
    made = dict(blocks.groupBy("__level").count().collect())
    used = sorted(made)
    values = df if how == "inner" else df.select(col).distinct()
    lookup = F.array(*[F.struct(F.lit(x).alias("l"), F.expr(f"shiftright(__at, {x * step})").alias("b")) for x in used]) if used else F.array().cast("array<struct<l:int,b:bigint>>")
    placed = values.withColumn("__at", number - first).withColumn("__look", F.explode(lookup))
    same = (F.col("__look.l") == F.col("__level")) & (F.col("__look.b") == F.col("__block"))
    hits = placed.join(F.broadcast(blocks) if sum(made.values()) <= FEW_BLOCKS else blocks.hint("merge"), same).drop("__at", "__look", "__level", "__block")
    return hits if how == "inner" else df.join(hits, col, "left")


GRAM = 6  # characters that find the candidates of a pattern
MARKS = 2**18  # bits of the filter that texts are read with: 32 KB, whatever the size of the dictionary


def _grams(text: Column, k: int) -> Column:
    """All pieces of k characters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - k + 1), lambda i: F.substr(text, i, F.lit(k)))
    return F.when(F.length(text) >= k, cut).otherwise(F.array().cast("array<string>"))


def _marks(grams: DataFrame) -> Column:
    """A fixed-size bitmap of a column ``g``, put together by Spark, as a literal."""
    place = F.pmod(F.xxhash64("g"), F.lit(MARKS))
    pieces = grams.groupBy(F.floor(place / 32768).alias("piece")).agg(F.bitmap_construct_agg(place % 32768).alias("bits")).collect()
    out = bytearray(MARKS // 8)
    for r in pieces:
        out[r["piece"] * 4096 : (r["piece"] + 1) * 4096] = r["bits"]
    return F.lit(bytes(out))


def like_candidates(texts: DataFrame, names: DataFrame) -> DataFrame:
    """``(__text, __name)`` pairs that share the pattern's rarest gram; every pair that matches is among them.

    A pattern's grams are the pieces of ``GRAM`` characters of its longest literal run (the run itself, if shorter).
    Texts yield only grams that some pattern uses: a bitmap drops nearly all others within the row, the join the rest.
    The texts per gram are counted, and each pattern is looked up by the gram that fewest texts have; one whose gram no
    text has is gone. A pattern without literal characters has the empty gram, which every text has.
    """
    runs = F.split("__name", r"[%_\\]")
    longest = F.reduce(runs, F.lit(""), lambda best, r: F.when(F.length(r) > F.length(best), r).otherwise(best))
    keyed = names.withColumn("__run", longest).withColumn("__k", F.least(F.length("__run"), F.lit(GRAM)))
    pieces = F.when(F.col("__k") == 0, F.array(F.lit("")))
    for k in range(1, GRAM + 1):
        pieces = pieces.when(F.col("__k") == k, F.array_distinct(_grams(F.col("__run"), k)))
    used = keyed.select("__name", F.explode(pieces).alias("g"))
    lengths = [r[0] for r in keyed.select("__k").distinct().collect()]  # GRAM + 1 numbers at most
    marks = _marks(used)

    def marked(g: Column) -> Column:
        place = F.pmod(F.xxhash64(g), F.lit(MARKS)).cast("int")
        byte = F.conv(F.hex(F.substr(marks, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.get(F.array(*[F.lit(1 << i) for i in range(8)]), place % 8).bitwiseAND(byte) > 0

    text = F.col("__text")
    found = [F.array(F.lit("")) if k == 0 else F.filter(_grams(text, k), marked) for k in lengths] or [F.array().cast("array<string>")]
    of_text = texts.select("__text", F.explode(F.array_distinct(F.concat(*found))).alias("g")).join(used.select("g").distinct(), "g", "left_semi")
    seen = of_text.groupBy("g").agg(F.count("*").alias("n"))
    everywhere = used.join(seen, "g", "left").groupBy("__name").agg(F.min_by("g", F.struct(F.coalesce("n", F.lit(0)), "g")).alias("g"))
    return of_text.join(everywhere, "g").select("__text", "__name")


def like_join(df: DataFrame, dictionary: DataFrame, col: str, pattern: str, how: str = "left") -> DataFrame:
    """Join on ``col LIKE '%' || pattern || '%'``, one row per match.

    Matches are found once per distinct text, at any size of the dictionary alike: an equi join on the rarest gram of
    each pattern gives the candidates (``like_candidates``), which are then verified.
    """
    texts = df.select(F.col(col).alias("__text")).filter(F.col(col).isNotNull()).distinct()
    names = dictionary.select(F.col(pattern).alias("__name")).filter(F.col(pattern).isNotNull()).distinct()
    pairs = like_candidates(texts, names).filter(F.expr("__text LIKE concat('%', __name, '%')"))
    matched = pairs.join(dictionary, F.col("__name") == F.col(pattern)).drop("__name")
    return df.join(matched, F.col(col) == F.col("__text"), how).drop("__text")


def self_prev_join(df: DataFrame, keys, rank_col: str, ok: Column) -> DataFrame:
    """Rows whose previous rank (rank - 1) of the same key has no row with ``ok``."""
    keys = _cols(keys)
    good = df.filter(ok).select(*keys, (F.col(rank_col) + 1).alias(rank_col)).distinct()
    return null_safe_join(df, good, [*keys, rank_col], "left_anti")


def join_parts(base: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Left-join report parts on the key; a column that is already there gets the part's name as suffix."""
    out = base
    for name, part in parts.items():
        taken = set(out.columns) - {key}
        out = out.join(part.select(*[F.col(c).alias(f"{c}_{name}") if c in taken else F.col(c) for c in part.columns]), key, "left")
    return out


def code_lookup(df: DataFrame, col: str, mapping: dict[str, str], name: str, default: str | None = None) -> DataFrame:
    """Constant map lookup as an expression (the map is code, hence bounded)."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(name, F.coalesce(F.try_element_at(pairs, _c(col)), F.lit(default)))
