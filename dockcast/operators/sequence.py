"""Per-station ordered computations that stay bounded under skew.

Everything the reference does with ``groupby(station).shift/rolling/ffill``
is an ordered computation inside one station.  The textbook Spark plan is a
window ``partitionBy(station).orderBy(ts)``: one shuffle, but one *task per
station*.  On a large cluster that task holds a whole station's history and a
hot station (a third of all rows) would sit in a single task.

``Sequencer`` therefore has two plans with identical results:

``key``      plain window per station.  Chosen when Catalyst's size estimate
             of the whole input fits one task (no job), or else when the
             per-station row count, measured by a cheap aggregate on the key
             column, is below ``max_key_rows``.
``blocked``  1. rows get a global per-station index ``_g`` from per-(station,
             time-chunk) counts, a prefix sum over the small chunk table and a
             row number inside each chunk;
             2. the index is cut into blocks of ``block_rows`` rows; each row is
             also copied into the neighbouring block when it lies within the
             look-back / look-ahead of that block (the halo, ≤ 2 extra copies,
             only near block edges);
             3. windows run per (station, block) ordered by ``_g`` and only the
             block's own rows are kept.
             Unbounded fills (ffill/bfill) use a carry from the chunk table
             instead of a halo.  Time chunks start at one day and narrow when
             a (station, chunk) exceeds ``max_chunk_rows`` (a size check on
             the counts).  Every task is bounded by the block or chunk size,
             whatever the key skew.

Row semantics: lags and rolling frames count rows, not minutes, as in the
original pandas code.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.columns import micros

_G = ROW_NUMBER = "_g"
KNOWN_BEFORE = "_known_before"
_HALO = "_halo"
BLK = "_blk"
CHUNK = "_chunk"
HOME = "_home"


def _estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the whole input (file sizes, projection-scaled); None if unknown."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. a Connect session: fall back to counting
        return None


@dataclass
class Sequencer:
    key: str | Sequence[str] = "station_id"
    order: Sequence[str] = ("ts",)
    strategy: str = "auto"              # auto | key | blocked
    chunk_seconds: int = 86_400         # time chunk used to number rows (≈288 ticks/day on the 5-min grid)
    block_rows: int = 4_096             # rows per block of the blocked plan
    max_key_rows: int = 2_000_000       # above this a station is too big for one task
    max_key_bytes: int = 512 << 20      # an input this small fits one task whole: no count needed
    max_chunk_rows: int = 1_000_000     # rows per (station, chunk) numbered in one task (blocked plan)
    _resolved: dict = field(default_factory=dict, repr=False)

    # ------------------------------------------------------------------ utils
    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def _order_cols(self) -> list[Column]:
        return [F.col(c).asc() for c in self.order]

    def key_window(self):
        return Window.partitionBy(*self.keys).orderBy(*self._order_cols())

    def resolve(self, df: DataFrame) -> str:
        """Pick the plan; ``auto`` measures the largest station once."""
        if self.strategy != "auto":
            return self.strategy
        if "s" not in self._resolved:
            est = _estimated_bytes(df)
            if est is not None and est <= self.max_key_bytes:
                self._resolved["s"] = "key"          # all stations together fit a task
            else:
                top = (df.groupBy(*self.keys).count().agg(F.max("count").alias("m")).collect()[0]["m"]) or 0
                self._resolved["s"] = "key" if top <= self.max_key_rows else "blocked"
        return self._resolved["s"]

    def chunk_width(self, df: DataFrame | None = None) -> int:
        """Seconds per time chunk of the blocked plan.

        Starts at ``chunk_seconds`` and, when ``df`` is given, narrows it (÷24,
        down to one second) until no (station, chunk) holds more than
        ``max_chunk_rows`` rows — a size check on per-chunk counts only, so
        dense data never puts an unbounded chunk into one task.
        """
        if "w" not in self._resolved:
            w = self.chunk_seconds
            if df is not None:
                while w > 1:
                    c = F.floor(micros(self.order[0]) / F.lit(w * 1_000_000))
                    top = (df.groupBy(*self.keys, c.alias("_c")).count()
                             .agg(F.max("count").alias("m")).collect()[0]["m"]) or 0
                    if top <= self.max_chunk_rows:
                        break
                    w = max(1, w // 24)
            self._resolved["w"] = w
        return self._resolved["w"]

    def with_strategy(self, strategy: str) -> "Sequencer":
        return Sequencer(self.key, tuple(self.order), strategy, self.chunk_seconds,
                         self.block_rows, self.max_key_rows, self.max_key_bytes, self.max_chunk_rows)

    def _chunk(self, df: DataFrame | None = None) -> Column:
        return F.floor(micros(self.order[0]) / F.lit(self.chunk_width(df) * 1_000_000))

    # ----------------------------------------------------------- row numbers
    def index(self, df: DataFrame, known: str | None = None) -> DataFrame:
        """Add ``_g``: 0-based row position inside the station (blocked plan); with ``known`` also
        ``KNOWN_BEFORE``, the number of that column's values before the row.

        Only (station, chunk) counts travel to the chunk-table prefix sum;
        rows are shuffled once, by (station, chunk), for the join and the
        in-chunk row number (the same partitioning serves both).
        """
        k = self.keys
        # reuse the chunk column of a preceding blocked fill: the rows are then
        # already partitioned by (station, chunk) and no new exchange is needed
        d = df if CHUNK in df.columns else df.withColumn(CHUNK, self._chunk(df))
        counts = d.groupBy(*k, "_chunk").agg(F.count(F.lit(1)).alias("_n"), F.count(known or F.lit(1)).alias("_m"))
        wc = Window.partitionBy(*k).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(*k, "_chunk", F.coalesce(F.sum("_n").over(wc), F.lit(0)).alias("_start"),
                               F.coalesce(F.sum("_m").over(wc), F.lit(0)).alias("_known"))
        d = d.join(starts, on=k + ["_chunk"], how="inner")
        wr = Window.partitionBy(*k, "_chunk").orderBy(*self._order_cols())
        d = d.withColumn(_G, F.col("_start") + F.row_number().over(wr) - 1)
        if known:
            d = d.withColumn(KNOWN_BEFORE, F.col("_known") + F.count(known).over(wr.rowsBetween(Window.unboundedPreceding, -1)))
        return d.drop("_chunk", "_start", "_known")

    def _halo(self, df: DataFrame, back: int, ahead: int) -> DataFrame:
        B = max(self.block_rows, back, ahead)     # a block must cover the look-back / look-ahead
        g = F.col(_G)
        blk = F.floor(g / B)
        pos = g - blk * B
        cands = [F.struct(blk.alias("b"), F.lit(True).alias("home"))]
        if back > 0:
            cands.append(F.when(pos >= B - back, F.struct((blk + 1).alias("b"), F.lit(False).alias("home"))))
        if ahead > 0:
            cands.append(F.when((pos < ahead) & (blk > 0), F.struct((blk - 1).alias("b"), F.lit(False).alias("home"))))
        t = F.col(_HALO)
        return (df.withColumn(_HALO, F.explode(F.array_compact(F.array(*cands))))
                  .withColumn(BLK, t.getField("b")).withColumn(HOME, t.getField("home")).drop(_HALO))

    # ------------------------------------------------------------- windows
    def windowed(self, df: DataFrame, back: int, ahead: int,
                 build: Callable[[DataFrame, "Window"], DataFrame], strategy: str | None = None) -> DataFrame:
        """Run ``build(df, w)`` where ``w`` orders one station's rows.

        ``build`` may only look ``back`` rows behind and ``ahead`` rows in
        front of the current row (lag/lead/rowsBetween within those bounds).
        """
        s = strategy or self.resolve(df)
        if s == "key":
            return build(df, self.key_window())
        d = df if _G in df.columns else self.index(df)
        d = self._halo(d, back, ahead)
        w = Window.partitionBy(*self.keys, BLK).orderBy(_G)
        out = build(d, w)
        return out.where(F.col(HOME)).drop(BLK, HOME, _G, CHUNK)

    # ---------------------------------------------------------------- fills
    def fill(self, df: DataFrame, col, forward: bool = True, backward: bool = True,
             out: str | None = None, strategy: str | None = None) -> DataFrame:
        """Forward fill then back fill of one column (or a list) within the station.

        ``blocked`` carries the last/first known value of each time chunk
        through a prefix over the (small) chunk table — one chunk table and
        one join for all columns.
        """
        cols = [col] if isinstance(col, str) else list(col)
        outs = {c: (out if (out and len(cols) == 1) else c) for c in cols}
        s = strategy or self.resolve(df)
        k = self.keys

        def turned(w):
            part = k if s == "key" else k + [CHUNK]
            return Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in self.order])

        def filled(c, w, cin=None, cout=None):
            expr = F.col(c)
            if forward:
                parts = [expr, F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))]
                expr = F.coalesce(*(parts + ([F.col(cin)] if cin else [])))
            if backward:
                # after the forward fill only rows before the first value are open: one value
                # for the whole partition, where a frame that starts at each row is quadratic
                if forward:
                    ahead = F.first(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                else:
                    ahead = F.last(c, ignorenulls=True).over(turned(w).rowsBetween(Window.unboundedPreceding, 0))
                expr = F.coalesce(*([expr, ahead] + ([F.col(cout)] if cout else [])))
            return expr

        if s == "key":
            w = self.key_window()
            return df.withColumns({outs[c]: filled(c, w) for c in cols})
        d = df if CHUNK in df.columns else df.withColumn(CHUNK, self._chunk(df))
        ordkey = F.struct(*[F.col(o) for o in self.order])
        aggs = []
        for i, c in enumerate(cols):
            known = F.when(F.col(c).isNotNull(), ordkey)
            aggs += [F.max_by(F.col(c), known).alias(f"_last{i}"), F.min_by(F.col(c), known).alias(f"_first{i}")]
        summ = d.groupBy(*k, CHUNK).agg(*aggs)
        wc = Window.partitionBy(*k).orderBy(CHUNK)
        wd = Window.partitionBy(*k).orderBy(F.col(CHUNK).desc())
        carries = []
        for i in range(len(cols)):
            carries += [F.last(f"_last{i}", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cin{i}"),
                        F.last(f"_first{i}", ignorenulls=True).over(wd.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cout{i}")]
        carry = summ.select(*k, CHUNK, *carries)
        d = d.join(carry, on=k + [CHUNK], how="inner")
        w = Window.partitionBy(*k, CHUNK).orderBy(*self._order_cols())
        d = d.withColumns({outs[c]: filled(c, w, f"_cin{i}", f"_cout{i}") for i, c in enumerate(cols)})
        # ``_chunk`` stays: a following ``index`` reuses it (``windowed`` drops it)
        return d.drop(*[f"_cin{i}" for i in range(len(cols))], *[f"_cout{i}" for i in range(len(cols))])
