"""Counts and sums by time band, from running sums; counts by distance from tiles, and in crowded ones from grids of running counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600


def seconds(column: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, as a whole number."""
    return F.unix_micros(column.cast("timestamp"))


def running_sums(points: DataFrame, keys: Sequence[str], values: Sequence[str], bucket: int | None, parts: int | None = None) -> DataFrame:
    """points with each value summed over the rows of the same keys that come no later, by _at (microseconds), then _turn.

    Sums run within buckets of time (seconds); those of the buckets before are added, of which a key has as many as its
    time spans. So no task holds more of a busy key than a bucket of it, and no rows are paired. parts: tasks that buckets are
    dealt into. Without a bucket a key's points are summed in one task, and are not dealt again if they lie by key.
    """
    if bucket is None:
        so_far = Window.partitionBy(*keys).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
        return points.withColumns({v: F.sum(v).over(so_far) for v in values})
    points = points.withColumn("_bucket", F.floor(F.col("_at") / (bucket * 1_000_000)))
    points = points.repartition(parts, *keys, "_bucket") if parts else points
    totals = points.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_before_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_bucket", *[F.coalesce(F.sum(f"_before_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values])
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    run = points.withColumns({v: F.sum(v).over(so_far) for v in values})
    run = run.join(totals, [*keys, "_bucket"])
    return run.withColumns({v: F.col(v) + F.col(f"_before_{v}") for v in values}).drop("_bucket", *[f"_before_{v}" for v in values])


def trailing_sums(left: DataFrame, right: DataFrame, ids: Sequence[str], keys: Sequence[str], left_time: str, right_time: str, spans: Mapping[str, int | tuple[int, int]], quantities: Mapping[str, str], closed: bool, bucket: int | None = 86_400, parts: int | None = None) -> DataFrame:
    """ids, and {quantity}_{span}: sums over the right rows of the same keys in [left - span, left), or with left if closed.

    A span is a number of seconds, or (months, days). Each sum is what has run up to the left time less what had run up
    to the span's start, so whole numbers are exact and rows needn't be paired. {span} itself counts the right rows; left
    rows without any in all spans have no row. Null keys meet nothing. parts: tasks that the rows are dealt into, each time.
    Without a bucket, for keys of few rows each (and ids that hold the keys), rows of either side are dealt once, by key: spans are
    laid out, summed and brought together again where they lie.
    """
    if bucket is None:
        left, right = (rows.repartition(*([parts] if parts else []), *keys) for rows in (left, right))
    when = F.col(left_time)
    start = lambda span: seconds(when) - span * 1_000_000 if isinstance(span, int) else seconds(when - F.make_interval(F.lit(0), F.lit(span[0]), F.lit(0), F.lit(span[1])))
    point = lambda k, at, turn: F.struct(F.lit(k).alias("span"), at.alias("at"), F.lit(turn).alias("turn"))
    names = list(dict.fromkeys([*ids, *keys]))
    values = {"_n": "1", **{f"_q{k}": f"coalesce({v}, 0)" for k, v in enumerate(quantities.values())}}
    asked = left.select(*names, F.explode(F.array(point(0, seconds(when), 2 if closed else 0), *[point(k, start(v), 0) for k, v in enumerate(spans.values(), 1)])).alias("_p"))
    asked = asked.select(*names, F.col("_p.span").alias("_span"), F.col("_p.at").alias("_at"), F.col("_p.turn").alias("_turn"))
    given = right.select(*keys, seconds(F.col(right_time)).alias("_at"), *[F.expr(v).alias(k) for k, v in values.items()]).dropna(subset=[*keys, "_at"])
    # right rows of one time are one
    given = given.groupBy(*keys, "_at").agg(*[F.sum(v).alias(v) for v in values]).withColumn("_turn", F.lit(1))
    points = asked.dropna(subset=[*keys, "_at"]).unionByName(given, allowMissingColumns=True).fillna(0, list(values))
    run = running_sums(points, keys, list(values), bucket, parts).filter("_span is not null").select(*ids, "_span", *values)
    run = run.repartition(parts, ids[0]) if parts and bucket is not None else run
    upto = lambda v, k: F.coalesce(F.sum(F.when(F.col("_span") == k, F.col(v))), F.lit(0))
    labels = {"_n": "", **dict(zip(list(values)[1:], (f"{q}_" for q in quantities), strict=True))}
    sums = run.groupBy(*ids).agg(*[(upto(v, 0) - upto(v, n)).alias(f"{label}{k}") for n, k in enumerate(spans, 1) for v, label in labels.items()])
    return sums.filter(F.greatest(*[F.col(k) for k in spans], F.lit(0)) > 0)


def _time_sums(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_time: str, spans: Mapping[str, int], quantities: Mapping[str, str], closed: bool) -> DataFrame:
    """left_id and the trailing sums of all right rows, by the hour; times that left rows share are asked for once."""
    times = left.select(seconds(F.col(left_time)).alias("_t"), F.col(left_time).alias("_when")).dropna().distinct()
    sums = trailing_sums(times, right, ["_t"], [], "_when", right_time, spans, quantities, closed, HOUR)
    met = left.select(left_id, seconds(F.col(left_time)).alias("_t")).join(sums, "_t")
    return met.groupBy(left_id).agg(*[F.sum(c).alias(c) for c in sums.columns if c != "_t"])


def band_counts(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_time: str, widths: Mapping[str, int], closed: bool = True, keep_empty: bool = False) -> DataFrame:
    """left_id and the number of right rows in each trailing band (D6, D7), from running counts by the hour.

    Left rows without a right row have no row, or counts of 0 with keep_empty.
    """
    out = _time_sums(left, right, left_id, left_time, right_time, widths, {}, closed)
    if keep_empty:
        out = left.select(left_id).distinct().join(out, left_id, "left").na.fill(0, list(widths))
    return out


def flagged_band_counts(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_time: str, bands: Mapping[str, tuple[str | None, int]], closed: bool = True) -> DataFrame:
    """left_id and the number of right rows in each band of (flag, seconds), all flags in one pass.

    A flag is an SQL condition of right rows, or None for all. A left row without a row of a flag in that flag's widest band
    has null in its bands; one without any has no row.
    """
    flags = list(dict.fromkeys(flag for flag, _ in bands.values()))
    spans = {f"w{s}": s for s in sorted({s for _, s in bands.values()})}
    sums = _time_sums(left, right, left_id, left_time, right_time, spans, {f"f{k}": f"cast({flag} as int)" if flag else "1" for k, flag in enumerate(flags)}, closed)
    count = lambda flag, s: F.col(f"f{flags.index(flag)}_w{s}")
    widest = {flag: max(s for own, s in bands.values() if own == flag) for flag in flags}
    return sums.select(left_id, *[F.when(count(flag, widest[flag]) > 0, count(flag, s)).alias(k) for k, (flag, s) in bands.items()])


def band_distinct_counts(left: DataFrame, right: DataFrame, left_id: str, entity: str, left_time: str, right_time: str, widths: Mapping[str, int]) -> DataFrame:
    """left_id and the number of distinct entities with a right row in each trailing band [left - width, left] (D7 by entity).

    A row stands for its entity from its time until the band leaves it or the entity's next row takes over; the
    entities at a time are those that have begun less those that have ended.
    """
    times = right.select(entity, seconds(F.col(right_time)).alias("_t")).dropna().distinct()
    times = times.withColumn("_next", F.lead("_t").over(Window.partitionBy(entity).orderBy("_t")))
    point = lambda k, at, turn, n: F.struct(F.lit(k).alias("span"), at.alias("at"), turn.alias("turn"), F.lit(n).alias("n"))
    changes = []
    for k, w in widths.items():
        leaves = F.col("_t") + w * 1_000_000
        taken = F.coalesce(F.col("_next") <= leaves, F.lit(False))
        changes += [point(k, F.col("_t"), F.lit(1), 1), point(k, F.when(taken, F.col("_next")).otherwise(leaves), F.when(taken, F.lit(1)).otherwise(F.lit(3)), -1)]
    asked = left.select(left_id, F.explode(F.array(*[point(k, seconds(F.col(left_time)), F.lit(2), 0) for k in widths])).alias("_p"))
    points = asked.unionByName(times.select(F.explode(F.array(*changes)).alias("_p")), allowMissingColumns=True)
    points = points.select(left_id, F.col("_p.span").alias("_span"), F.col("_p.at").alias("_at"), F.col("_p.turn").alias("_turn"), F.col("_p.n").alias("n")).dropna(subset=["_at"])
    run = running_sums(points, ["_span"], ["n"], HOUR).filter("_turn = 2")
    return run.groupBy(left_id).agg(*[F.sum(F.when(F.col("_span") == k, F.col("n"))).alias(k) for k in widths])


#: Right rows of one tile and time bucket up to which left rows are compared with each of them.
CROWDED = 2_048
#: Blocks of a circle's radius, at least, and cells of a block's side.
BLOCKS, CELLS = 4, 4
#: Cells count as inside or outside a circle by this share of its square radius; between, points are compared one by one.
MARGIN = 1e-9


def _range(low: Column, high: Column) -> Column:
    return F.explode(F.when(low <= high, F.sequence(low, high)))


def _reach(column: str, cell: Column, side: float) -> tuple[Column, Column]:
    """The least and the greatest distance of a coordinate from a cell's points, in one direction."""
    below, above = F.col(column) - cell * side, (cell + 1) * side - F.col(column)
    return F.greatest(-below, -above, F.lit(0.0)), F.greatest(F.abs(below), F.abs(above))


def _placed(rows: DataFrame, radius: float, side: float) -> DataFrame:
    """rows with _inside (all of the cell _cx, _cy lies in the circle); cells outside are left out."""
    (nx, fx), (ny, fy) = _reach("_lon", F.col("_cx"), side), _reach("_lat", F.col("_cy"), side)
    rows = rows.withColumn("_inside", fx * fx + fy * fy <= radius * radius * (1 - MARGIN))
    return rows.filter(nx * nx + ny * ny <= radius * radius * (1 + MARGIN))


def _crowded_counts(left: DataFrame, right: DataFrame, ids: Sequence[str], keys: Sequence[str], spans: Mapping[str, int], radius: float, tile: float) -> DataFrame:
    """ids and the number of right rows of the left rows' tiles in each trailing band within one radius.

    left: ids, _when, _lon, _lat and the tile _x, _y, _b; right: keys, _when, _lon, _lat and its tile. A circle is laid out in blocks, and
    the blocks on its border in cells. Blocks and cells that lie inside give their running counts at the band's ends; only
    points of the cells on the border are compared, so what is joined grows with the border and not with the area.
    """
    parts = 1
    while tile / parts > radius / BLOCKS:
        parts *= 2
    block, cell = tile / parts, tile / parts / CELLS
    own = ["_b", *keys]
    at = lambda c, t: _range(F.greatest(F.floor((F.col(c) - radius) / block), F.col(t) * parts), F.least(F.floor((F.col(c) + radius) / block), F.col(t) * parts + parts - 1))
    blocks = _placed(left.withColumn("_cx", at("_lon", "_x")).withColumn("_cy", at("_lat", "_y")), radius, block)
    each = _range(F.lit(0), F.lit(CELLS - 1))
    cells = blocks.filter("not _inside").withColumn("_i", each).withColumn("_j", each)
    cells = _placed(cells.withColumn("_cx", F.col("_cx") * CELLS + F.col("_i")).withColumn("_cy", F.col("_cy") * CELLS + F.col("_j")), radius, cell)
    names = list(dict.fromkeys([*ids, "_when", *own, "_level", "_cx", "_cy"]))
    # the cell of a point is that within its block, so that rounding can't part the two
    points = right.withColumn("_bx", F.floor(F.col("_lon") / block)).withColumn("_by", F.floor(F.col("_lat") / block))
    part = lambda c, b: F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor((F.col(c) - F.col(b) * block) / cell)))
    fine = points.withColumn("_level", F.lit(1)).withColumn("_cx", F.col("_bx") * CELLS + part("_lon", "_bx")).withColumn("_cy", F.col("_by") * CELLS + part("_lat", "_by"))
    coarse = points.withColumn("_level", F.lit(0)).withColumn("_cx", F.col("_bx")).withColumn("_cy", F.col("_by"))
    given = coarse.unionByName(fine).select(*own, "_level", "_cx", "_cy", F.col("_when").alias("_r"))
    asked = blocks.filter("_inside").withColumn("_level", F.lit(0)).select(*names).unionByName(cells.filter("_inside").withColumn("_level", F.lit(1)).select(*names))
    inner = trailing_sums(asked, given, list(ids), ["_level", "_cx", "_cy", *own], "_when", "_r", spans, {}, False)
    others = fine.select(*own, "_cx", "_cy", seconds(F.col("_when")).alias("_rt"), F.col("_lon").alias("_rlon"), F.col("_lat").alias("_rlat"))
    dx, dy = F.col("_lon") - F.col("_rlon"), F.col("_lat") - F.col("_rlat")
    border = cells.filter("not _inside").join(others, ["_cx", "_cy", *own]).withColumn("_lt", seconds(F.col("_when"))).filter((F.col("_rt") < F.col("_lt")) & (dx * dx + dy * dy <= radius * radius))
    border = border.groupBy(*ids).agg(*[F.count_if(F.col("_lt") - F.col("_rt") <= w * 1_000_000).alias(k) for k, w in spans.items()])
    return inner.select(*ids, *spans).unionByName(border)


def _reaching(rows: DataFrame, width: int, reach: float, size: int, tile: float) -> DataFrame:
    """_rt, _rlon, _rlat, how many rows have these (_n), and each tile and bucket (_x, _y, _b) with a later point within reach."""
    sites = rows.select(seconds(F.col("_when")).alias("_rt"), F.col("_lon").alias("_rlon"), F.col("_lat").alias("_rlat")).groupBy("_rt", "_rlon", "_rlat").agg(F.count("*").alias("_n"))
    spread = lambda c: _range(F.floor((F.col(c) - reach) / tile), F.floor((F.col(c) + reach) / tile))
    return sites.withColumn("_x", spread("_rlon")).withColumn("_y", spread("_rlat")).withColumn("_b", _range(F.floor((F.col("_rt") + 1) / size), F.floor((F.col("_rt") + width) / size)))


def radius_counts(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_time: str, bands: Mapping[str, tuple[int, float]], point: tuple[str, str] = ("lon", "lat"), keys: Sequence[str] = ()) -> DataFrame:
    """left_id (and keys) and the number of right rows in each band of (seconds, radius): left - seconds <= right < left, planar
    distance in the unit of the coordinates (D13, D14). Left rows without a row in the widest band have no row.

    Rows meet in time buckets twice as wide as the widest band, of which a left row looks into those that its band reaches. Where there are keys
    and up to CROWDED right rows share them and a bucket, it is compared with each of them; other buckets are laid out in square tiles of twice
    the widest radius. In tiles of up to CROWDED right rows a left row is compared with each again; in others a grid of running
    counts is asked, and only rows of cells on the circle's border are compared (_crowded_counts). So a left row's
    work has a bound for each bucket and tile, however dense that is, and it is laid out in tiles only where that is needed.
    Without keys left rows stay in their own tile and bucket; right rows of one time and place are one there, and go to the tiles they reach.
    """
    from ..sources import io

    ids = [left_id, *keys]
    width, radius = max(w for w, _ in bands.values()), max(r for _, r in bands.values())
    every, reach = {**bands, "_widest": (width, radius)}, radius * (1 + MARGIN)
    size, tile, tiles = 2 * width * 1_000_000, 2 * radius, ["_x", "_y", "_b", *keys]
    place = [F.col(point[0]).cast("double").alias("_lon"), F.col(point[1]).cast("double").alias("_lat")]
    given = right.select(*keys, F.col(right_time).alias("_when"), *place).dropna(subset=["_lon", "_lat"])  # NaN too
    given = given.withColumn("_b", F.floor(seconds(F.col("_when")) / size))
    asked = left.select(*ids, F.col(left_time).alias("_when"), *place).dropna(subset=["_lon", "_lat"]).withColumn("_lt", seconds(F.col("_when")))
    alone = asked
    asked = asked.withColumn("_b", _range(F.floor((F.col("_lt") - width * 1_000_000) / size), F.floor((F.col("_lt") - 1) / size)))
    dx, dy = F.col("_lon") - F.col("_rlon"), F.col("_lat") - F.col("_rlat")
    age, square = F.col("_lt") - F.col("_rt"), dx * dx + dy * dy

    def near(asked: DataFrame, given: DataFrame, own: Sequence[str]) -> DataFrame:
        others = given.select(*own, seconds(F.col("_when")).alias("_rt"), F.col("_lon").alias("_rlon"), F.col("_lat").alias("_rlat"))
        pairs = asked.drop("_when").join(others, own).filter((age > 0) & (age <= width * 1_000_000) & (square <= radius * radius))
        return pairs.groupBy(*ids).agg(*[F.count_if((age <= w * 1_000_000) & (square <= r * r)).alias(k) for k, (w, r) in every.items()])

    def reached(given: DataFrame) -> DataFrame:
        others = _reaching(given, width * 1_000_000, reach, size, tile)
        own = alone.select(*ids, "_lon", "_lat", "_lt", F.floor(F.col("_lon") / tile).alias("_x"), F.floor(F.col("_lat") / tile).alias("_y"), F.floor(F.col("_lt") / size).alias("_b"))
        pairs = own.join(others, tiles).filter((age > 0) & (age <= width * 1_000_000) & (square <= radius * radius))
        return pairs.groupBy(*ids).agg(*[F.sum(F.when((age <= w * 1_000_000) & (square <= r * r), F.col("_n")).otherwise(0)).alias(k) for k, (w, r) in every.items()])

    def split(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
        return rows.join(groups, groups.columns, "left_anti"), rows.join(groups, groups.columns, "left_semi")

    def over(rows: DataFrame, own: Sequence[str]) -> DataFrame:
        return rows.groupBy(*own).count().filter(F.col("count") > CROWDED).select(*own)

    out = None
    if keys:  # of few keys with many rows the buckets are counted, so that those of all keys needn't be
        known = io.stored(over(given, keys), "busy")
        busy = io.stored(over(given.join(known, list(keys), "left_semi"), ["_b", *keys]), "busy")
        if busy.isEmpty():
            return near(asked, given, ["_b", *keys]).filter("_widest > 0").select(*ids, *bands)
        (few, asked), (some, given) = split(asked, busy), split(given, busy)
        out = near(few, some, ["_b", *keys])

    given = given.withColumn("_x", F.floor(F.col("_lon") / tile)).withColumn("_y", F.floor(F.col("_lat") / tile))
    spread = lambda c: _range(F.floor((F.col(c) - reach) / tile), F.floor((F.col(c) + reach) / tile))
    asked = asked.withColumn("_x", spread("_lon")).withColumn("_y", spread("_lat"))
    crowded = io.stored(over(given, tiles), "crowded")
    any_crowded = not crowded.isEmpty()
    (few, dense), (some, there) = (split(asked, crowded), split(given, crowded)) if any_crowded else ((asked, None), (given, None))
    out = out.unionByName(near(few, some, tiles)) if keys else reached(some)
    if any_crowded:
        for r in dict.fromkeys(r for _, r in every.values()):
            spans = {k: w for k, (w, own) in every.items() if own == r}
            out = out.unionByName(_crowded_counts(dense.drop("_lt"), there, ids, keys, spans, r, tile), allowMissingColumns=True)
    out = out.groupBy(*ids).agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in every])
    return out.filter("_widest > 0").select(*ids, *bands)


def entity_radius_counts(left: DataFrame, right: DataFrame, left_id: str, entity: str, left_time: str, right_time: str, bands: Mapping[str, tuple[int, float]], functions: Mapping[str, str], point: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """left_id and, for each band, a function (avg, max) over its entities of their own rows in the band.

    left has a row for each left_id and entity. Rows meet on entity and time bucket, a busy entity's on tiles too, as in radius_counts;
    entities without a row in the widest band don't count.
    """
    counted = radius_counts(left, right, left_id, left_time, right_time, bands, point, (entity,))
    # a band's mean is over the entities that have a row in it
    each = [getattr(F, f)(F.when(F.col(k) > 0, F.col(k))).alias(f"{f}_{k}") for k in bands for f in functions.values()]
    return counted.groupBy(left_id).agg(*each)
