"""Re-joining ballots whose pages were scanned as separate rows.

Exact rule.  Rows are walked in file order.  A row whose target is missing and
that no earlier row consumed looks for the nearest row of its group with a
known target: first one step ahead, then one step back, two ahead, two back,
...  It fills its own missing cells from the row found, which is consumed, and
now counts as a row with a known target itself.  The search ends once the step
ahead leaves the file, so a row at place i of n reaches back n-1-i steps at most.

Why this can be done in bounded pieces.  Within a group, rows ahead are consumed
from the nearest on, so the consumed ones are always the next few complete rows:
a count describes them.  Behind, a row that consumes its predecessor takes that
row's place, so only the latest complete row can ever be chosen.  Finally, of two
successive rows that reach ahead the second found its match at most as far away
as the first one lies behind it; distances double, so the count stays below
log2(n) + 2.  Hence the state after a row is its place and a small count, and a
stretch of rows is a map from counts to counts.  Pass one computes that map for
every stretch, the maps of a group are chained (one short row per stretch), and
pass two replays each stretch from its true state.  No task ever holds more than
one stretch of a group.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import strip_bracket_suffix
from tallyline.operators.groups import running_number
from tallyline.shipping import by_value

by_value(__name__)

#: More than any reachable count of consumed rows ahead (log2 of the row count).
AHEAD = 64
#: State after a missing row that found nothing: no later row finds anything.
DEAD = -1


class _Stretch:
    """The rows of one group inside one index range, plus what surrounds them."""

    def __init__(self, rows: list[tuple[int, bool]], info: dict) -> None:
        self.steps = sorted(rows)
        self.last = info["n_rows"]
        self.complete = [i for i, missing in self.steps if not missing] + info["ahead"]
        self.before_missing = info["before_missing"]
        self.before_complete = info["before_complete"]
        self.between = info["between"]
        self.plain = not any(missing for _, missing in self.steps)

    def run(self, count: int, origin: int | None, record: list | None = None) -> tuple[int, int | None, bool]:
        """Walk the rows from the state after the last missing row before them.

        ``count`` is the number of consumed rows ahead there (or DEAD) and
        ``origin`` names the chain that row ended.  Returns the same two for
        the last missing row of this stretch, and whether the chain of the
        start is still the open one.  ``record`` collects (idx, origin).
        """
        inherited = True
        if count == DEAD:
            return DEAD, None, False
        top, top_origin = self.before_missing, origin
        if self.before_complete is not None and (self.before_missing is None or self.between > count):
            top, top_origin, inherited = self.before_complete, self.before_complete, False
        used = max(0, count - self.between)
        out = (count, origin, True)
        for i, missing in self.steps:
            if not missing:
                if used:
                    used -= 1
                else:
                    top, top_origin, inherited = i, i, False
                continue
            place = bisect_right(self.complete, i) + used
            ahead = self.complete[place] if place < len(self.complete) else None
            behind = top if top is not None and i - top <= self.last - i else None
            if ahead is not None and (behind is None or ahead - i <= i - behind):
                top, top_origin, inherited = i, ahead, False
                used += 1
                if used >= AHEAD:
                    raise OverflowError("more rows consumed ahead than a file of any length allows")
            elif behind is not None:
                top = i
            else:
                return DEAD, None, False
            if record is not None:
                record.append((i, top_origin))
            out = (used, top_origin, inherited)
        return out


_KEYS = "scope string, grp string, chunk long"
_INFO = ("before_missing", "before_complete", "between", "ahead", "n_rows")


def _arrow(rows: list[tuple], **columns: pa.DataType) -> pa.RecordBatch:
    """Row tuples as an Arrow batch of the given column types."""
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pa.record_batch({n: pa.array(list(v), type=t) for (n, t), v in zip(columns.items(), values)})


_GROUP = {"scope": pa.string(), "grp": pa.string()}


def _by_stretch(base: DataFrame, info: DataFrame) -> DataFrame:
    """Rows dealt by stretch, in front of each stretch a ``head`` row with what surrounds it.

    A task holds many stretches and reads them one after another: files of many
    small groups have nearly as many stretches as groups.
    """
    keys = ["scope", "grp", "chunk"]
    head = info.select(*keys, F.lit(True).alias("head"), *[c for c in info.columns if c not in keys])
    rows = base.select(*keys, F.lit(False).alias("head"), "idx", "missing")
    both = rows.unionByName(head, allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, F.col("head").desc())


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[dict, list[tuple[int, bool]]]]]:
    """The (head, rows) that end within each batch; the one a batch ends in goes on in the next."""
    head, rows = None, []
    for batch in batches:
        done, marks = [], batch.column("head")
        starts, heads = pc.indices_nonzero(marks).to_pylist(), batch.filter(marks).to_pylist()
        idx, missing = batch.column("idx").to_pylist(), batch.column("missing").to_pylist()
        rows += zip(idx[: starts[0]], missing[: starts[0]]) if starts else zip(idx, missing)
        for opened, start, end in zip(heads, starts, [*starts[1:], len(idx)]):
            if head is not None:
                done.append((head, rows))
            head, rows = opened, list(zip(idx[start + 1 : end], missing[start + 1 : end]))
        yield done
    if head is not None:
        yield [(head, rows)]


def _transitions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each reachable count before a stretch: the state after it."""
    for done in _stretches(batches):
        made = []
        for head, rows in done:
            stretch, states, seen = _Stretch(rows, head), [], {}
            # a count above log2(place) + 2 cannot occur; with no missing row before, it is 0
            most = 0 if stretch.before_missing is None else min(AHEAD - 1, stretch.before_missing.bit_length() + 2)
            for count in range(most + 1):
                # counts used up before the stretch all start it alike
                start = DEAD if count < stretch.between else count
                if start not in seen:
                    seen[start] = stretch.run(count, None)
                after, origin, inherits = seen[start]
                # a stretch without missing rows hands the count on as it came
                states.append((count if inherits and stretch.plain else after, origin, inherits))
            made.append((head["scope"], head["grp"], head["chunk"], *map(list, zip(*states))))
        yield _arrow(
            made, **_GROUP, chunk=pa.int64(), count_out=pa.list_(pa.int32()), origin_out=pa.list_(pa.int64()), inherits=pa.list_(pa.bool_())
        )


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the maps of each group in file order: the true state before each stretch."""
    group, count, origin = None, 0, None
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            if (row["scope"], row["grp"]) != group:
                group, count, origin = (row["scope"], row["grp"]), 0, None
            made.append((*group, row["chunk"], count, origin))
            if count == DEAD:
                continue
            if not row["inherits"][count]:
                origin = row["origin_out"][count]
            count = row["count_out"][count]
        yield _arrow(made, **_GROUP, chunk=pa.int64(), count_in=pa.int32(), origin_in=pa.int64())


def _replay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for done in _stretches(batches):
        made = []
        for head, rows in done:
            if head["count_in"] is None:
                continue
            record: list[tuple] = []
            _Stretch(rows, head).run(head["count_in"], head["origin_in"], record)
            made += [(head["scope"], head["grp"], i, o) for i, o in record]
        yield _arrow(made, **_GROUP, idx=pa.int64(), origin=pa.int64())


def pair_origins(rows: DataFrame, sizes: DataFrame | int, stretch: int = 1 << 16) -> DataFrame:
    """(scope, grp, idx, missing) -> (scope, grp, idx, origin).

    ``idx`` runs 1..n per scope (a file), ``sizes`` holds n as ``n_rows``
    (or is n itself, for a single scope).  ``origin`` is the index of the
    complete row a missing row was finally filled from; rows with the same
    origin make up one ballot.  Unmatched rows are absent.
    """
    base = rows.where(F.col("grp").isNotNull()).select(
        "scope", "grp", "idx", "missing", F.floor(F.col("idx") / stretch).alias("chunk")
    )
    complete = F.when(~F.col("missing"), F.col("idx"))
    summary = base.groupBy("scope", "grp", "chunk").agg(
        F.max(F.when(F.col("missing"), F.col("idx"))).alias("last_missing"),
        F.max(complete).alias("last_complete"),
        F.array_sort(F.collect_list(complete)).alias("found"),  # one stretch at most
    )
    tail = F.when(
        F.col("last_missing").isNotNull(), F.size(F.filter("found", lambda i: i > F.col("last_missing")))
    )
    summary = summary.select(
        "*",
        F.size("found").alias("n_complete"),
        tail.alias("n_tail"),
        F.slice("found", 1, AHEAD).alias("first"),
    ).drop("found")
    order = Window.partitionBy("scope", "grp").orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.sum("n_complete").over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = summary.withColumn("__upto", upto).withColumn("__at_missing", F.col("__upto") - F.col("n_tail"))
    around = marked.select(
        "scope",
        "grp",
        "chunk",
        F.max("last_missing").over(earlier).alias("before_missing"),
        F.max("last_complete").over(earlier).alias("before_complete"),
        (
            F.coalesce(F.max("__upto").over(earlier), F.lit(0))
            - F.coalesce(F.max("__at_missing").over(earlier), F.lit(0))
        ).alias("between"),
        "first",
        "n_complete",
    )
    info = _with_ahead(around)
    single = isinstance(sizes, int)
    info = info.withColumn("n_rows", F.lit(sizes).cast("bigint")) if single else info.join(sizes, "scope")
    info = info.select("scope", "grp", "chunk", *_INFO)
    maps = _by_stretch(base, info).mapInArrow(
        _transitions, f"{_KEYS}, count_out array<int>, origin_out array<long>, inherits array<boolean>"
    )
    in_order = maps.repartition("scope", "grp").sortWithinPartitions("scope", "grp", "chunk")
    states = in_order.mapInArrow(_chain, f"{_KEYS}, count_in int, origin_in long")
    # every stretch keeps its head, so that rows never follow that of another
    started = info.join(states, ["scope", "grp", "chunk"], "left")
    return _by_stretch(base, started).mapInArrow(_replay, "scope string, grp string, idx long, origin long")


def _with_ahead(around: DataFrame) -> DataFrame:
    """The next complete rows after each stretch, at most AHEAD of them.

    A reverse running count tells how many complete rows follow; stretches
    whose own first rows fall inside the window of AHEAD are gathered by a
    short frame.  Empty stretches carry nothing, so the frame counts complete
    rows, not stretches.
    """
    after = Window.partitionBy("scope", "grp").orderBy("__rank").rangeBetween(1, AHEAD)
    # rank stretches that hold complete rows; others share the rank of the one before
    rank = F.sum(F.when(F.col("n_complete") > 0, 1).otherwise(0)).over(
        Window.partitionBy("scope", "grp").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = around.withColumn("__rank", rank)
    gathered = F.flatten(F.collect_list(F.when(F.col("n_complete") > 0, F.col("first"))).over(after))
    return ranked.withColumn("ahead", F.slice(F.array_sort(gathered), 1, AHEAD)).drop("__rank", "first", "n_complete")


def pair_split_rows(
    df: DataFrame,
    idx: str,
    group: str,
    target: str,
    scope: Sequence[str] = (),
    strip_page_mark: bool = True,
    stretch: int = 1 << 16,
) -> DataFrame:
    """Merge ballots split over several rows; exact greedy rule (see module).

    ``idx`` numbers the rows of a scope (file) from 1.  Rows without a group or
    without a match stay as they are.  Of a merged ballot, every column takes
    the first known value in the order of consumption, and ``idx`` is that of
    the row that consumed the others.
    """
    grouped = df.withColumn(group, strip_bracket_suffix(group)) if strip_page_mark else df
    keyed = grouped.withColumn(
        "__scope", F.concat_ws("\u0001", F.lit("s"), *[F.col(s).cast("string") for s in scope])
    )
    slim = keyed.select(
        F.col("__scope").alias("scope"), F.col(group).cast("string").alias("grp"),
        F.col(idx).cast("bigint").alias("idx"), F.col(target).isNull().alias("missing"),
    )
    n_rows = F.max("idx").alias("n_rows")
    # without a scope the size is one number, not a table to join
    sizes = slim.groupBy("scope").agg(n_rows) if scope else (slim.agg(n_rows).head()[0] or 0)
    origins = pair_origins(slim, sizes, stretch).select(F.col("scope").alias("__scope"), F.col("idx").alias(idx), "origin")
    placed = keyed.join(origins, ["__scope", idx], "left")
    own = F.when(F.col(target).isNotNull() & F.col(group).isNotNull(), F.col(idx))
    # an unmatched row is a ballot of its own, told apart by its sign
    ballot = F.coalesce(F.col("origin"), own, -F.col(idx))
    # merged rows come latest first, the complete row they started from last
    turn = F.when(F.col("origin").isNotNull(), F.col(idx)).otherwise(F.lit(0))
    rest = [c for c in df.columns if c != idx]
    folded = placed.withColumn("__ballot", ballot).withColumn("__turn", turn).groupBy("__scope", "__ballot").agg(
        F.max_by(F.col(idx), F.col("__turn")).alias(idx),
        *[
            F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("__turn"))).alias(c)
            for c in rest
        ],
    )
    return folded.select(*[F.col(f"`{c}`") for c in df.columns])


def pair_rows_ranked(
    df: DataFrame, idx: str, group: str, target: str, scope: Sequence[str] = (), stretch: int = 1 << 16
) -> DataFrame:
    """Relaxed pairing: the k-th incomplete row of a group joins the k-th complete one.

    Both sides keep unmatched rows.  Returns (scope..., group, k, idx_incomplete,
    idx_complete).
    """
    keys = [*scope, group]
    known = df.where(F.col(group).isNotNull()).select(*keys, idx, F.col(target).isNull().alias("__missing"))
    ranked = running_number(known, [*keys, "__missing"], idx, "k", stretch)
    return ranked.groupBy(*keys, "k").agg(
        F.max(F.when(F.col("__missing"), F.col(idx))).alias("idx_incomplete"),
        F.max(F.when(~F.col("__missing"), F.col(idx))).alias("idx_complete"),
    )
