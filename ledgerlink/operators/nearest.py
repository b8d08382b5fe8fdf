"""Best rows by amount and date inside groups too large to pair.

The value of a point for a query is ``base + amount_part(|dx|) + date_part(gap)``.
A query may ask several groups, each with a ``base`` of its own; it wants its k
best points of all of them.

Points and questions lie in one order of (group, amount), cut into ranges of
equal size, whichever groups that cuts through. Inside its range a question
walks over the points to both sides, nearest amounts first, and by turns over the
days, nearest first, from each of which it takes the best amounts; until even a
point of the next amount on the next day could not reach the k-th best value
found. That is a few points where amounts are dense, and a few days where they
are far apart.

A range knows the k points before and after it, its halo. They bound the k-th
value of questions near its ends, and so how far beyond the halo such a question
can still matter: those few questions meet the points of other ranges within
that reach in a second step. Only events, open questions and points near the ends
of ranges are written or shuffled, never pairs.

The groups of a query's highest base come first. The k-th best value found in
them bounds the others: a group whose base cannot reach it is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.config import AMOUNT_WEIGHT, DATE_WEIGHT, MISSING_DATE_DAYS
from ledgerlink.functions.scoring import MONEY_UNITS, amount_part, date_part, from_units
from ledgerlink.session import checkpointed, cut_lineage

_NO_DATE = -(2**31)
_ROW = ["run_id", "erp_ord"]
_QUERY = [*_ROW, "grp", "base", "x", "day"]
#: Points and questions that one range holds, in memory of its task.
RANGE_ROWS = 150_000
_SORTED = ["run_id", "grp", "list", "x", "ord"]
#: More days than this are not listed to tell the best date that occurs.
_MOST_DAYS = 50_000
_SLACK = 1e-9
_HIT = "run_id string, erp_ord bigint, grp string, base double, x bigint, day int, bank_ord bigint, px bigint, pday int"


def nearest_in_groups(
    queries: DataFrame, points: DataFrame, k: int, max_delta: Decimal | None = None
) -> DataFrame:
    """The k best points of each ledger row's groups, as (run_id, erp_ord, bank_ord).

    ``queries``: run_id, erp_ord, grp, base, gross, date; one row per group asked.
    ``points``: run_id, grp, bank_ord, settled, settlement_date; of the groups that
    one row asks, a point is in one only. ``gross`` and ``settled`` are in money
    units. Ties go to the lower ``bank_ord``. ``max_delta`` excludes points
    further away. A row may get a few more than k. No points or no queries give no rows.
    """
    asked = _asked(queries)
    top = F.max("base").over(Window.partitionBy(*_ROW))
    asked = cut_lineage(asked.withColumn("leads", F.col("base") == top))
    known, limit = cut_lineage(_known(points)), _limit(max_delta)
    hits = _closest(asked.where("leads").select(*_QUERY), known, k, limit)
    others = asked.where("not leads")
    if not others.isEmpty():
        hits = cut_lineage(hits)
        most = AMOUNT_WEIGHT + DATE_WEIGHT + _SLACK
        bounded = others.join(_kth_values(hits, k), _ROW, "left").where(
            F.col("floor").isNull() | (F.col("base") + most >= F.col("floor"))
        )
        hits = hits.unionByName(_closest(cut_lineage(bounded.select(*_QUERY, "floor")), known, k, limit))
    return hits.select(*_ROW, "bank_ord")


def nearest_in_runs(queries: DataFrame, points: DataFrame, k: int, max_delta: Decimal) -> DataFrame:
    """The k best points of each ledger row in its run, at most ``max_delta`` away.

    As :func:`nearest_in_groups` with one group a run and no base; with the distance in
    money units and the gap in days of each hit: (run_id, erp_ord, bank_ord, delta_units, days).
    """
    one = F.lit("").alias("grp")
    asked = _asked(queries.select("run_id", one, "erp_ord", F.lit(0.0).alias("base"), "gross", "date"))
    known = _known(points.select("run_id", one, "bank_ord", "settled", "settlement_date"))
    return _closest(asked, known, k, _limit(max_delta)).select(
        *_ROW, "bank_ord", F.abs(F.col("x") - F.col("px")).alias("delta_units"),
        _gap(F.col("day"), F.col("pday")).alias("days"),
    )


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select(
        *_ROW, "grp", "base", F.col("gross").alias("x"), _day_number(F.col("date")).alias("day")
    )


def _known(points: DataFrame) -> DataFrame:
    return points.select(
        "run_id", "grp", "bank_ord", F.col("settled").alias("px"), _day_number(F.col("settlement_date")).alias("pday")
    )


def _limit(max_delta: Decimal | None) -> int | None:
    return None if max_delta is None else int(max_delta * MONEY_UNITS)


def _day_number(date: Column) -> Column:
    return F.coalesce(F.unix_date(date), F.lit(_NO_DATE))


def _gap(day: Column, other: Column) -> Column:
    missing = (day == _NO_DATE) | (other == _NO_DATE)
    return F.when(missing, MISSING_DATE_DAYS).otherwise(F.abs(day - other))


def _kth_values(hits: DataFrame, k: int) -> DataFrame:
    """(run_id, erp_ord, floor): the k-th best value of each ledger row that has k hits.

    A point of a halo may be hit twice, and counts once.
    """
    delta = from_units(F.abs(F.col("x") - F.col("px")))
    value = F.col("base") + amount_part(delta) + date_part(_gap(F.col("day"), F.col("pday")))
    order = Window.partitionBy(*_ROW).orderBy(F.col("value").desc(), "bank_ord")
    once = hits.select(*_ROW, "bank_ord", value.alias("value")).repartition(*_ROW).distinct()
    ranked = once.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= k).where(F.col("place") == k).select(*_ROW, F.col("value").alias("floor"))


def _closest(asked: DataFrame, known: DataFrame, k: int, limit: int | None) -> DataFrame:
    """The best points of the group of every question, beside it: the k best are among them.

    ``asked`` may have a ``floor``, below which no value is of use.
    """
    events = known.select(
        "run_id", "grp", F.lit(0).alias("list"), F.col("px").alias("x"), F.col("bank_ord").alias("ord"),
        F.col("pday").alias("day"), F.lit(None).cast("double").alias("base"),
    )
    schema = _EVENTS
    if "floor" in asked.columns:
        events, schema = events.withColumn("floor", F.lit(None).cast("double")), _FLOORED
    events = events.unionByName(asked.select(
        F.lit(0).alias("list"), F.col("erp_ord").alias("ord"), *[c for c in asked.columns if c != "erp_ord"]
    ))
    ranges = _sorted_ranges(events)
    halos = _halos(ranges, k, schema)
    days = _days_of(known)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = _whole(batches, schema)
        found = _walked(table, halos[number], k, limit, days)
        if found is not None:
            yield from _hit_rows(*found[:4]).to_batches(max_chunksize=50_000)

    def unfinished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = _whole(batches, schema)
        found = _walked(table, halos[number], k, limit, days)
        if found is not None:
            yield from _open_rows(number, *found).to_batches(max_chunksize=50_000)

    inside = ranges.mapInArrow(hits, _HIT)
    open_ = cut_lineage(ranges.mapInArrow(unfinished, _OPEN))
    wanted = _wanted(open_, halos)
    if not wanted:
        return inside

    def lent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = _whole(batches, schema)
        if len(table) and number in wanted:
            yield from _lent_rows(table.take(_points_of(table)), wanted[number], k).to_batches(max_chunksize=50_000)

    def beyond(key: tuple, questions: pa.Table, points: pa.Table) -> pa.Table:
        return _hit_rows(*_best_points(questions, points, k, limit, days)[:4])

    away = ranges.mapInArrow(lent, _LENT)
    far = open_.groupBy("range").cogroup(away.groupBy("range")).applyInArrow(beyond, _HIT)
    return inside.unionByName(far)


_OPEN = (
    "range int, run_id string, grp string, x bigint, ord bigint, day int, base double, floor double, lo bigint, hi bigint"
)
_LENT = "range int, run_id string, grp string, x bigint, ord bigint, day int"


def _days_of(known: DataFrame) -> np.ndarray | None:
    """The days that occur among the points, in order; None when there are too many to list."""
    rows = known.select("pday").distinct().limit(_MOST_DAYS + 1).collect()
    return None if len(rows) > _MOST_DAYS else np.array(sorted(r.pday for r in rows), np.int64)


def _amount_value(delta: np.ndarray) -> np.ndarray:
    return (1.0 / (1.0 + delta / float(MONEY_UNITS))) * AMOUNT_WEIGHT


def _date_value(gap: np.ndarray) -> np.ndarray:
    return (1.0 / (1.0 + gap)) * DATE_WEIGHT


def _best_date_value(day: np.ndarray, days: np.ndarray | None) -> np.ndarray:
    """The most that a date can add to a question's value, whatever point it meets."""
    gap = np.zeros(len(day))
    if days is not None:
        gap[:] = MISSING_DATE_DAYS
        dated = days[days != _NO_DATE]
        has = np.flatnonzero(day != _NO_DATE)
        if len(dated):
            at = np.searchsorted(dated, day[has])
            below = np.abs(day[has] - dated[np.maximum(at - 1, 0)])
            above = np.abs(dated[np.minimum(at, len(dated) - 1)] - day[has])
            near = np.minimum(below, above)
            gap[has] = near if len(dated) == len(days) else np.minimum(near, MISSING_DATE_DAYS)
    else:
        gap[day == _NO_DATE] = MISSING_DATE_DAYS
    return _date_value(gap)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _group_codes(questions: pa.Table, points: pa.Table) -> np.ndarray:
    """A number for the (run_id, grp) of every question, then of every point."""
    codes = np.zeros(len(questions) + len(points), np.int64)
    for name in ("run_id", "grp"):
        both = pa.chunked_array(
            [*questions.column(name).chunks, *points.column(name).chunks], pa.string()
        ).combine_chunks().dictionary_encode()
        codes = codes * (len(both.dictionary) + 1) + both.indices.fill_null(len(both.dictionary)).to_numpy()
    return codes


def _few_alike(code: np.ndarray, x: np.ndarray, day: np.ndarray, ord_: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of every run of sorted points equal in group, amount and day; repeats of a point are one."""
    new = np.ones(len(x), bool)
    new[1:] = (code[1:] != code[:-1]) | (x[1:] != x[:-1]) | (day[1:] != day[:-1])
    other = new.copy()
    other[1:] |= ord_[1:] != ord_[:-1]
    place = np.cumsum(other)
    return np.flatnonzero(other & (place - place[np.flatnonzero(new)][np.cumsum(new) - 1] < k))


class _Best:
    """The k best points of every question so far, best first: their values, keys and places; ties go to the lower key."""

    def __init__(self, floor: np.ndarray, k: int, keys: np.ndarray):
        self.value = np.repeat(floor[:, None], k, axis=1)
        self.owner = np.full((len(floor), k), np.iinfo(np.int64).max)
        self.place = np.full((len(floor), k), -1, np.int64)
        self._keys, self._last = keys, k - 1

    def can_take(self, row: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a point of at most that value can still be among the best."""
        return most >= self.value[row, self._last] - _SLACK

    def offer(self, row: np.ndarray, at: np.ndarray, got: np.ndarray) -> None:
        """Take the points ``at``, one for each of these questions, where they are better; a repeated one counts once."""
        last, key = self._last, self._keys[at]
        worst = self.value[row, last]
        better = (got > worst) | ((got == worst) & (key < self.owner[row, last]))
        row, at, got, key = row[better], at[better], got[better], key[better]
        new = ~((self.value[row] == got[:, None]) & (self.owner[row] == key[:, None])).any(axis=1)
        row = row[new]
        self.value[row, last], self.owner[row, last], self.place[row, last] = got[new], key[new], at[new]
        for j in range(last, 0, -1):
            up = (self.value[row, j] > self.value[row, j - 1]) | (
                (self.value[row, j] == self.value[row, j - 1]) & (self.owner[row, j] < self.owner[row, j - 1])
            )
            row = row[up]
            for kept in (self.value, self.owner, self.place):
                kept[row, j], kept[row, j - 1] = kept[row, j - 1], kept[row, j]


class _Days:
    """Sorted points by the days of their groups: on one day only the amount tells which is best."""

    def __init__(self, code: np.ndarray, px: np.ndarray, pday: np.ndarray):
        self._order = np.lexsort((px, pday, code))
        code, day = code[self._order], pday[self._order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (day[1:] != day[:-1])
        starts = np.flatnonzero(new)
        self.day = day[starts]
        self._bounds = np.r_[starts, len(code)]
        self._groups, group = np.unique(code[starts], return_inverse=True)
        self._keys = self._key(group, self.day)
        self._levels = np.unique(px)
        self._width = len(self._levels) + 1
        self._sorted = (np.cumsum(new) - 1) * self._width + np.searchsorted(self._levels, px[self._order])

    @staticmethod
    def _key(group: np.ndarray, day: np.ndarray) -> np.ndarray:
        return group * 2**33 + (day - _NO_DATE)

    def around(self, code: np.ndarray, day: np.ndarray) -> tuple[np.ndarray, ...]:
        """(undated, first, at, end) of questions whose groups have points: the number of the group's undated points, or -1,
        those of its dated days, and of the first day that is not before the question's."""
        group = np.searchsorted(self._groups, code)
        first = np.searchsorted(self._keys, self._key(group, np.int64(_NO_DATE)))
        has_undated = self.day[first] == _NO_DATE
        end = np.searchsorted(self._keys, self._key(group + 1, np.int64(_NO_DATE)))
        at = np.searchsorted(self._keys, self._key(group, day))
        return np.where(has_undated, first, -1), first + has_undated, np.maximum(at, first + has_undated), end

    def walk(self, number: np.ndarray, x: np.ndarray, step: int, met: Callable) -> None:
        """From the amounts ``x`` to one side over the points of one day each, nearest first.

        ``met`` gets the rows and places of those still on their way and tells which of them go on.
        """
        at = np.searchsorted(self._sorted, number * self._width + np.searchsorted(self._levels, x)) - (step < 0)
        rows = np.arange(len(number))
        low, high = self._bounds[number], self._bounds[number + 1]
        while True:
            inside = (at >= low[rows]) & (at < high[rows])
            rows, at = rows[inside], at[inside]
            if not len(rows):
                return
            on = met(rows, self._order[at])
            rows, at = rows[on], at[on] + step


def _best_points(questions: pa.Table, points: pa.Table, k: int, limit: int | None, days: np.ndarray | None):
    """(questions, points, rows, places, ends): the k best points of every question's group among ``points``.

    ``rows`` and ``places`` pair questions with points. ``ends``: the k-th value of each
    question, what a date can add at most, and the amounts of the outermost points of its group.

    By turns a question takes the next nearest amounts, whatever their dates, and the best amounts of its next
    nearest day. A point met by neither way is worth no more than the next amount on the next day, which ends the search.
    """
    n = len(questions)
    codes = _group_codes(questions, points)
    q_code, p_code = codes[:n], codes[n:]
    px, pord, pday = _column(points, "x"), _column(points, "ord"), _column(points, "day").astype(np.int64)
    order = np.lexsort((pord, pday, px, p_code))
    order = order[_few_alike(p_code[order], px[order], pday[order], pord[order], k)]
    p_code, px, pord, pday = p_code[order], px[order], pord[order], pday[order]
    x, day, base = _column(questions, "x"), _column(questions, "day").astype(np.int64), _column(questions, "base")
    floor = np.full(n, -np.inf)
    if "floor" in questions.column_names:
        given = _column(questions, "floor").astype(float)
        floor = np.where(np.isnan(given), -np.inf, given)
    first, last = np.searchsorted(p_code, q_code, "left"), np.searchsorted(p_code, q_code, "right")
    best = _Best(floor, k, pord)
    if len(px):
        _search(best, (q_code, x, day, base), (p_code, px, pday), first, last, limit)
        low, high = px[np.minimum(first, len(px) - 1)], px[np.maximum(last - 1, 0)]
    else:
        low = high = x
    rows, slots = np.nonzero(best.place >= 0)
    return questions, points, rows, order[best.place[rows, slots]], (best.value[:, k - 1], _best_date_value(day, days), low, high)


def _search(best: _Best, asked: tuple, known: tuple, first: np.ndarray, last: np.ndarray, limit: int | None) -> None:
    """Find the best points of all questions; ``known`` is sorted by group and amount, ``first`` to ``last`` is the group's."""
    (q_code, x, day, base), (p_code, px, pday) = asked, known
    n = len(x)
    merged = np.lexsort((np.r_[np.zeros(n, np.int8), np.ones(len(px), np.int8)], np.r_[x, px], np.r_[q_code, p_code]))
    before = np.cumsum(merged >= n)
    above = np.empty(n, np.int64)
    above[merged[merged < n]] = before[merged < n]
    below = above - 1
    act = np.flatnonzero(first < last)
    dates = _Days(p_code, px, pday)
    undated, day_first, later, day_end = (np.zeros(n, np.int64) for _ in range(4))
    undated[act], day_first[act], later[act], day_end[act] = dates.around(q_code[act], day[act])
    earlier = later - 1

    def of_one_day(row: np.ndarray, number: np.ndarray, date_value: np.ndarray) -> None:
        def met(one: np.ndarray, at: np.ndarray) -> np.ndarray:
            delta = np.abs(x[row[one]] - px[at])
            got = base[row[one]] + _amount_value(delta) + date_value[one]
            on = best.can_take(row[one], got)
            if limit is not None:
                on &= delta <= limit
            best.offer(row[one][on], at[on], got[on])
            return on

        for step in (-1, 1):
            dates.walk(number, x[row], step, met)

    def next_amount(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the next amount of a side is worth with the base; nothing at the end of the group or limit."""
        inside = (at >= first[row]) & (at < last[row])
        delta = np.abs(x[row] - px[np.where(inside, at, 0)])
        if limit is not None:
            inside &= delta <= limit
        return np.where(inside, base[row] + _amount_value(delta), -np.inf)

    some = act[(undated[act] >= 0) & (day[act] != _NO_DATE)]
    of_one_day(some, undated[some], np.full(len(some), _date_value(float(MISSING_DATE_DAYS))))
    while len(act):
        dated = day[act] != _NO_DATE
        back = np.where(earlier[act] >= day_first[act], day[act] - dates.day[np.maximum(earlier[act], 0)], np.inf)
        on = np.where(later[act] < day_end[act], dates.day[np.minimum(later[act], len(dates.day) - 1)] - day[act], np.inf)
        gap = np.where(dated, np.minimum(back, on), float(MISSING_DATE_DAYS))
        date_value = np.where(np.isinf(gap), -np.inf, _date_value(gap))
        sides = [next_amount(act, side[act]) for side in (below, above)]
        most = np.maximum(*sides)
        open_ = best.can_take(act, most + date_value) & (most + date_value > -np.inf)
        act, dated, back, gap, date_value, most = (v[open_] for v in (act, dated, back, gap, date_value, most))
        for side, near, step in ((below, sides[0][open_], -1), (above, sides[1][open_], 1)):
            taken = best.can_take(act, near + date_value) & (near > -np.inf)
            row, at = act[taken], side[act[taken]]
            undated_pair = (day[row] == _NO_DATE) | (pday[at] == _NO_DATE)
            got = near[taken] + _date_value(np.where(undated_pair, MISSING_DATE_DAYS, np.abs(day[row] - pday[at])))
            best.offer(row, at, got)
            side[row] += step
        visited = dated & best.can_take(act, most + date_value)
        row, is_back = act[visited], (back <= gap)[visited]
        of_one_day(row, np.where(is_back, earlier[row], later[row]), date_value[visited])
        earlier[row[is_back]] -= 1
        later[row[~is_back]] += 1


def _hit_rows(questions: pa.Table, points: pa.Table, rows: np.ndarray, places: np.ndarray) -> pa.Table:
    q, p = questions.take(rows), points.take(places)
    return pa.table({
        "run_id": q["run_id"], "erp_ord": q["ord"], "grp": q["grp"], "base": q["base"], "x": q["x"], "day": q["day"],
        "bank_ord": p["ord"], "px": p["x"], "pday": p["day"],
    })


def _walked(table: pa.Table, halo: tuple[list, list], k: int, limit: int | None, days: np.ndarray | None):
    """:func:`_best_points` of a range and its halo, with how far beyond the halo each question can matter."""
    if not len(table):
        return None
    is_question = pa.compute.is_valid(table.column("base"))
    questions = table.filter(is_question)
    if not len(questions):
        return None
    sides = [
        pa.table([list(c) for c in zip(*rows)] if rows else [[]] * len(table.schema), schema=table.schema) for rows in halo
    ]
    points = pa.concat_tables([sides[0], table.filter(pa.compute.invert(is_question)), sides[1]]).combine_chunks()
    *found, (kth, date_most, low, high) = _best_points(questions, points, k, limit, days)
    x, base = _column(questions, "x"), _column(questions, "base")
    room = kth - base - date_most - _SLACK
    reach = np.full(len(x), 2**62, np.int64)
    some = room > 0
    reach[some] = np.minimum(np.ceil((AMOUNT_WEIGHT / room[some] - 1.0) * MONEY_UNITS) + 1, 2**62).astype(np.int64)
    if limit is not None:
        reach = np.minimum(reach, limit)
    open_ = []
    for rows, outermost, away in ((halo[0], 0, x - low), (halo[1], -1, high - x)):
        more = len(rows) == k  # else no point lies beyond
        group = rows[outermost][:2] if more else None
        same = np.zeros(len(x), bool)
        if more:
            same = pa.compute.and_(
                pa.compute.equal(questions.column("run_id"), group[0]), pa.compute.equal(questions.column("grp"), group[1])
            ).combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
        open_.append(same & (away <= reach))
    return *found, (kth, x, np.minimum(reach, 2**61), open_)


def _open_rows(number: int, questions: pa.Table, points: pa.Table, rows, places, ends) -> pa.Table:
    """The questions of a range that points beyond its halo can still matter to, and the amounts of these."""
    kth, x, reach, (down, up) = ends
    picked = np.flatnonzero(down | up)
    q = questions.take(picked)
    x, reach, down, up = x[picked], reach[picked], down[picked], up[picked]
    out = {"range": pa.array(np.full(len(picked), number, np.int32))}
    out |= {name: q[name] for name in ("run_id", "grp", "x", "ord", "day", "base")}
    out["floor"] = pa.array(kth[picked])
    out["lo"] = pa.array(np.where(down, x - reach, x))
    out["hi"] = pa.array(np.where(up, x + reach, x))
    return pa.table(out)


def _wanted(open_: DataFrame, halos: list) -> dict[int, list[tuple]]:
    """Per range, who wants points of it: (asking range, run_id, grp, lowest and highest amount).

    Only the first and the last group of a range can go on elsewhere, so at most two rows a range are collected.
    """
    asking = open_.groupBy("range", "run_id", "grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    wanted: dict[int, list[tuple]] = {}
    for row in asking:
        group = (row.run_id, row.grp)
        for step, side, end in ((-1, 0, -1), (1, 1, 0)):
            home = row.range
            while halos[home][side]:
                following = halos[home][side][end]  # the next point that side of the range
                if following[:2] != group or not row.lo <= following[3] <= row.hi:
                    break
                home += step
                wanted.setdefault(home, []).append((row.range, *group, row.lo, row.hi))
    return wanted


def _lent_rows(points: pa.Table, asking: list[tuple], k: int) -> pa.Table:
    """The points of a range that other ranges want, once for each of them."""
    parts = []
    for number, run_id, grp, lo, hi in asking:
        x = points.column("x")
        fits = pa.compute.and_(pa.compute.greater_equal(x, lo), pa.compute.less_equal(x, hi))
        for name, value in (("run_id", run_id), ("grp", grp)):
            fits = pa.compute.and_(fits, pa.compute.equal(points.column(name), value))
        own = points.filter(fits).select(["run_id", "grp", "x", "ord", "day"])
        x, day, ord_ = _column(own, "x"), _column(own, "day"), _column(own, "ord")
        order = np.lexsort((ord_, day, x))
        own = own.take(order[_few_alike(np.zeros(len(x)), x[order], day[order], ord_[order], k)])
        parts.append(own.add_column(0, "range", pa.array(np.full(len(own), number, np.int32))))
    return pa.concat_tables(parts)


def neighbours(asked: DataFrame, listed: DataFrame, k: int) -> DataFrame:
    """``asked`` rows beside the k points before and the k after them in their list.

    ``asked``: the query columns and ``list``; ``listed``: run_id, grp, list, px,
    bank_ord, pday. Adds bank_ord, px and pday. Both are sorted by
    (list, amount) into ranges of about :data:`RANGE_ROWS`; questions of equal
    amount differ in their row number, so that no key is too hot to be cut.
    """
    points = listed.select(
        "run_id", "grp", "list", F.col("px").alias("x"), F.col("bank_ord").alias("ord"), F.col("pday").alias("day"),
        F.lit(None).cast("double").alias("base"),
    )
    events = points.unionByName(asked.select(
        "run_id", "grp", "list", "x", F.col("erp_ord").alias("ord"), "day", "base"
    ))
    ranges = _sorted_ranges(cut_lineage(events))
    halos = _halos(ranges, k, _EVENTS)
    found = ranges.mapInArrow(
        lambda batches: _answers(batches, halos, k),
        "run_id string, erp_ord bigint, grp string, base double, x bigint, day int, list int,"
        " bank_ord bigint, px bigint, pday int",
    )
    return found


def _sorted_ranges(events: DataFrame) -> DataFrame:
    """``events`` in one order, cut into ranges of equal size and written once."""
    spark = events.sparkSession
    rows = events.count()
    n = max(spark.sparkContext.defaultParallelism, -(-rows // RANGE_ROWS))
    ranges = events.repartitionByRange(n, *_SORTED).sortWithinPartitions(*_SORTED)
    # the number is stored: in a later union a task's number is not that of its range
    return checkpointed(ranges.withColumn("range", F.spark_partition_id()))


def _points_of(table: pa.Table) -> np.ndarray:
    return np.flatnonzero(table.column("base").is_null().to_numpy())


def _halos(ranges: DataFrame, k: int, schema: pa.Schema) -> list[tuple[list, list]]:
    """The k points before and after every range; 2 k rows a range are all the driver sees."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = _whole(batches, schema)
        at = _points_of(table)
        for side, picked in enumerate((at[:k], at[max(0, len(at) - k):])):
            rows = table.take(picked)
            number = pa.array([n] * len(picked), pa.int32())
            rows = rows.append_column("range", number).append_column("side", pa.array([side] * len(picked), pa.int32()))
            yield from rows.to_batches()

    kinds = {pa.string(): "string", pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double"}
    shape = ", ".join(f"{f.name} {kinds[f.type]}" for f in schema) + ", range int, side int"
    first, last = {}, {}
    for row in ranges.mapInArrow(ends, shape).collect():
        (last if row.side else first).setdefault(row.range, []).append(tuple(row)[:-2])
    n = ranges.rdd.getNumPartitions()
    before, after = [[]], [[]]
    for i in range(n - 1):
        before.append((before[-1] + last.get(i, []))[-k:])
        after.append((first.get(n - 1 - i, []) + after[-1])[:k])
    return list(zip(before, reversed(after)))


_EVENTS = pa.schema([
    ("run_id", pa.string()), ("grp", pa.string()), ("list", pa.int32()), ("x", pa.int64()), ("ord", pa.int64()),
    ("day", pa.int32()), ("base", pa.float64()),
])
_FLOORED = _EVENTS.append(pa.field("floor", pa.float64()))


def _whole(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> tuple[pa.Table, int]:
    """The rows of a range, whose size is bounded by :data:`RANGE_ROWS`, and its number; 0 when it is empty."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return schema.empty_table(), 0
    number = parts[0].column(parts[0].schema.get_field_index("range"))[0].as_py()
    return pa.Table.from_batches(parts).select(schema.names).cast(schema), number


def _answers(batches: Iterator[pa.RecordBatch], halos: list, k: int) -> Iterator[pa.RecordBatch]:
    """The neighbours of the questions of one range, halo points beside its own."""
    table, number = _whole(batches, _EVENTS)
    if not len(table):
        return
    before, after = halos[number]
    halo = [
        pa.table([list(c) for c in zip(*rows)] if rows else [[]] * len(_EVENTS), schema=_EVENTS) for rows in (before, after)
    ]
    table = pa.concat_tables([halo[0], table, halo[1]]).combine_chunks()
    starts = np.zeros(len(table), bool)
    for name in ("run_id", "grp", "list"):
        column = table.column(name).combine_chunks()
        starts[1:] |= pa.compute.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    lists = np.cumsum(starts)
    points = _points_of(table)
    is_point = np.zeros(len(table), bool)
    is_point[points] = True
    asks = np.flatnonzero(~is_point)
    seen = np.cumsum(is_point)[asks]
    rows, hits = [], []
    for j in range(k):
        for at in (seen - 1 - j, seen + j):
            inside = (at >= 0) & (at < len(points))
            hit = points[at[inside]]
            same = lists[hit] == lists[asks[inside]]
            rows.append(asks[inside][same])
            hits.append(hit[same])
    q, p = table.take(np.concatenate(rows)), table.take(np.concatenate(hits))
    out = pa.table({
        "run_id": q["run_id"], "erp_ord": q["ord"], "grp": q["grp"], "base": q["base"], "x": q["x"], "day": q["day"],
        "list": q["list"], "bank_ord": p["ord"], "px": p["x"], "pday": p["day"],
    })
    yield from out.to_batches(max_chunksize=50_000)
