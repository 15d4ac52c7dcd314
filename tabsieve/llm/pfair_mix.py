"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL
operations only.

Each source's rows, in an order fixed by hash, are cut into blocks of
``block_rows``.  A source of weight w gets block k no earlier than slot
floor(k / w) and no later than slot ceil((k + 1) / w); of the blocks that may
run, the one with the earliest deadline takes the slot.  At every slot each
source is then less than one block away from its share.

Weights are used unrounded over the whole run.  Let every source's share grow
by weight * v with a common v until its blocks are used up; v(t) is where the
shares sum to t.  Block k is released when the share passes k and due when it
reaches k + 1, so a source that runs dry leaves the others' proportions as they
are, and at every slot a source is less than one block from its share.

The slots are decided one after another from each source's count alone, one
step a slot over all sources.  A first pass keeps the counts at the beginning
of each stretch of slots; the stretches are then scheduled side by side.  All
rows come back.

With a ``period`` the schedule is periodic instead, with weights rounded to
whole blocks a period: a source may then drift from its share, by up to half a
block a period (more below half a block a period).  Only the periods where a
source runs dry, and the one after, differ: at most 2 * sources + 1 kinds are
scheduled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.session import ensure_checkpoint_dir, shuffle_partitions

BLOCK_ROWS = 64
#: A source without a positive weight gets one block in so many of the others'.
PERIOD = 200
#: Slots of a stretch, at least.
STRETCH = 1_000
#: Weight of a source without a given one: its rows to this power.
TEMPERATURE = 0.5
#: Rows of one source that one task numbers, about.
BUCKET_ROWS = 20_000


def target_weights(counts: DataFrame, weights: DataFrame | None, temperature: float = TEMPERATURE) -> DataFrame:
    """(src, n, weight): given weights of (source, weight), else n ** temperature.
    A source that ``weights`` leaves out, or gives no positive weight, has 0: it
    gets one block a period, or in ``PERIOD`` of the others'."""
    if weights is None:
        return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    given = weights.groupBy(source_key(F.col("source")).alias("src")).agg(F.max("weight").cast("double").alias("weight"))
    return counts.join(given, "src", "left").withColumn(
        "weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(0.0)))


def source_key(source):
    """Text key of a source; null is a source of its own."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source.cast("string")))


def period_kinds(targets: DataFrame, block_rows: int, period: int) -> DataFrame:
    """One row a kind of period: (first: its first period, base: slots before
    it, size: its slots, src: sources, blocks: each one's blocks in it).

    The table of sources is gathered in one row here: one entry a source."""
    total = F.sum("weight").over(Window.partitionBy(F.lit(0)))
    rate = F.greatest(F.lit(1), F.round(F.try_divide(F.col("weight"), total) * period)).cast("bigint")
    one = (targets.select("src", F.ceil(F.col("n") / block_rows).cast("bigint").alias("nb"),
                          F.coalesce(rate, F.lit(1).cast("bigint")).alias("q"))
           .agg(F.sort_array(F.collect_list(F.struct("src", "nb", "q"))).alias("s")))
    breaks = one.select("s", F.expr("""
        explode(array_sort(array_distinct(flatten(transform(s, x ->
            array(0L, x.nb div x.q, x.nb div x.q + 1L))))))""").alias("first"))
    return (breaks.selectExpr(
        "first", "transform(s, x -> x.src) as src",
        "transform(s, x -> least(x.q, greatest(0L, x.nb - first * x.q))) as blocks",
        "aggregate(s, 0L, (a, x) -> a + least(x.nb, first * x.q)) as base")
        .withColumn("size", F.expr("aggregate(blocks, 0L, (a, x) -> a + x)")).filter("size > 0"))


#: Earliest deadline first over one period: at slot t the sources that have
#: blocks left and whose next one is released; the nearest deadline wins, the
#: first source on a tie.
EARLIEST_DEADLINE = """
aggregate(
  sequence(0L, size - 1L),
  named_struct('done', transform(blocks, x -> 0L), 'runs', cast(array() as array<struct<i: int, k: bigint>>)),
  (st, t) -> transform(
    array(array_min(filter(
      transform(blocks, (x, i) -> if(st.done[i] < x and st.done[i] * size div x <= t,
        named_struct('due', ((st.done[i] + 1L) * size + x - 1L) div x, 'i', i, 'k', st.done[i]), null)),
      y -> y is not null))),
    w -> named_struct(
      'done', transform(st.done, (v, i) -> if(i = w.i, v + 1L, v)),
      'runs', concat(st.runs, array(named_struct('i', w.i, 'k', w.k)))))[0]
).runs
"""


def source_lines(targets: DataFrame, block_rows: int) -> DataFrame:
    """(src, nb: blocks, w: share of the weights, used, open) a source.  While
    this source is the next to run dry, ``used`` blocks belong to sources that
    have, and the others' weights sum to ``open``; so v(t) is the largest
    (t - used) / open of all sources."""
    sound = (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    top = F.max(F.when(sound, F.col("weight"))).over(Window.partitionBy(F.lit(0)))
    w = targets.withColumn("w", F.when(sound, F.col("weight") / top))
    given = F.coalesce(F.sum("w").over(Window.partitionBy(F.lit(0))), F.lit(float(PERIOD)))
    rows = (w.withColumn("w", F.coalesce("w", given / PERIOD))
            .select("src", F.ceil(F.col("n") / block_rows).cast("bigint").alias("nb"), "w"))
    dry = Window.partitionBy(F.lit(0)).orderBy(F.col("nb") / F.col("w"), "src")
    late = Window.partitionBy(F.lit(0)).orderBy((F.col("nb") / F.col("w")).desc(), F.col("src").desc())
    return rows.select("src", "nb", "w",
                       F.coalesce(F.sum("nb").over(dry.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                       .alias("used"),
                       F.sum("w").over(late.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("open"))


#: Slot t over the sources ``s``, of which ``{done}`` blocks have run: of those
#: with a block that is released before the slot ends, the one whose next block
#: is due first; the first source on a tie.  Shares sum to the slots, so one is
#: always at least 1 / sources ahead of its blocks, far above the tolerance that
#: keeps rounding errors from releasing a block early.
DUE_FIRST = """
array_min(filter(transform(
    array(array_max(transform(s, x -> (t + 1 - x.used) / x.open))),
    v -> transform(s, (x, i) -> if({done}[i] < x.nb and x.w * v - {done}[i] > 1e-6,
      named_struct('due', ({done}[i] + 1) / x.w, 'i', i, 'k', {done}[i]), null)))[0],
  y -> y is not null))
"""
STEP = "transform(array(%s), y -> transform({done}, (d, i) -> if(i = y.i, d + 1L, d)))[0]" % DUE_FIRST

#: (first, done) of every stretch of ``stretch`` slots.
STRETCHES = f"""
aggregate(
  sequence(0L, total - 1L, stretch),
  named_struct('done', transform(s, x -> 0L), 'out', cast(array() as array<struct<first: bigint, done: array<bigint>>>)),
  (st, f) -> named_struct(
    'done', aggregate(sequence(f, least(total, f + stretch) - 1L), st.done, (c, t) -> {STEP.format(done='c')}),
    'out', concat(st.out, array(named_struct('first', f, 'done', st.done))))
).out
"""

#: The runs of one stretch, slot by slot.
RUNS = f"""
aggregate(
  sequence(first, least(total, first + stretch) - 1L),
  named_struct('done', done, 'runs', cast(array() as array<struct<i: int, k: bigint>>)),
  (st, t) -> transform(array({DUE_FIRST.format(done='st.done')}), z -> named_struct(
    'done', transform(st.done, (d, i) -> if(i = z.i, d + 1L, d)),
    'runs', concat(st.runs, array(named_struct('i', z.i, 'k', z.k)))))[0]
).runs
"""


def block_slots(targets: DataFrame, block_rows: int, period: int | None = None) -> DataFrame:
    """(src, b, slot): the slot of every block of every source."""
    if period is not None:
        return periodic_slots(targets, block_rows, period)
    # one entry a source is gathered in one row
    one = (source_lines(targets, block_rows)
           .agg(F.sort_array(F.collect_list(F.struct("src", "nb", "w", "used", "open"))).alias("s"),
                F.sum("nb").alias("total")).filter("total > 0")
           # stretches and slots of a stretch grow alike, as do the sources a stretch carries
           .withColumn("stretch", F.expr(f"greatest({STRETCH}L, cast(size(s) as bigint), cast(sqrt(total) as bigint))")))
    stretches = (one.select("s", "total", "stretch", F.explode(F.expr(STRETCHES)).alias("z"))
                 .select("s", "total", "stretch", "z.first", "z.done")
                 .repartition(shuffle_partitions(targets.sparkSession), "first").checkpoint())
    return (stretches.select("s", "first", F.posexplode(F.expr(RUNS)).alias("t", "run"))
            .select(F.expr("s[run.i].src").alias("src"), F.col("run.k").alias("b"),
                    (F.col("first") + F.col("t")).alias("slot")))


def periodic_slots(targets: DataFrame, block_rows: int, period: int) -> DataFrame:
    """(src, b, slot) of the periodic schedule."""
    kinds = period_kinds(targets, block_rows, period).repartition(
        shuffle_partitions(targets.sparkSession), "first").checkpoint()
    runs = (kinds.select("first", "src", F.posexplode(F.expr(EARLIEST_DEADLINE)).alias("t", "run"))
            .select("first", F.element_at("src", F.col("run.i") + 1).alias("src"), F.col("run.k").alias("k"), "t"))
    spans = kinds.select("first", "base", "size", F.lead("first").over(
        Window.partitionBy(F.lit(0)).orderBy("first")).alias("next"))
    # periods of a kind repeat until the next kind begins; a kind past the last block has no row
    rates = kinds.filter("first = 0").select(F.explode(F.arrays_zip("src", "blocks")).alias("z")).select("z.*")
    whole = targets.select("src", F.ceil(F.col("n") / block_rows).cast("bigint").alias("nb"))
    # every source takes its full rate in the first period, or all it has
    of_kind = runs.join(spans, "first").join(whole, "src").join(
        rates.withColumnRenamed("blocks", "q"), "src")
    periods = of_kind.select(
        "src", "k", "t", "base", "size", "first", "q", "nb",
        F.explode(F.sequence("first", F.greatest("first", F.coalesce(
            F.col("next") - 1, F.expr("(nb - 1) div q"))))).alias("j"))
    return (periods.select("src", (F.col("j") * F.col("q") + F.col("k")).alias("b"),
                           (F.col("base") + (F.col("j") - F.col("first")) * F.col("size") + F.col("t")).alias("slot"),
                           "nb")
            .filter("b < nb").select("src", "b", "slot"))


def mix(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", block_rows: int = BLOCK_ROWS,
        period: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(row: struct of all columns of ``docs``, block, slot, position) of every
    row.  ``position`` orders the rows: slot * block_rows + place in the block
    (numbers are left out where a source's last block is short).

    Null is a source like any other; nulls elsewhere do not matter; equal rows
    are numbered one after another; an empty table gives an empty result."""
    return _mix(docs, weights, source, block_rows, period, temperature)[0]


def _mix(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", block_rows: int = BLOCK_ROWS,
         period: int | None = None, temperature: float = TEMPERATURE) -> tuple[DataFrame, int]:
    """The mixed rows and the number of slots."""
    ensure_checkpoint_dir(docs.sparkSession)
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).select(
        "row", source_key(F.col("row")[source]).alias("src"), F.xxhash64("row").alias("h"))
    total = docs.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    bucketed = keyed.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    # rows of a source are numbered bucket by bucket, so a large source is many tasks' work
    groups = bucketed.groupBy("src", "bucket").agg(F.count("*").alias("m")).checkpoint()
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    targets = target_weights(groups.groupBy("src").agg(F.sum("m").alias("n")), weights, temperature).checkpoint()
    slots = block_slots(targets, block_rows, period)
    # a bucket's blocks as one array: rows find their slot without a shuffle of their own
    first = F.expr(f"before div {block_rows}")
    last = F.expr(f"(before + m - 1) div {block_rows}")
    wanted = groups.select("src", "bucket", "before", F.explode(F.sequence(first, last)).alias("b"))
    found = (wanted.join(slots, ["src", "b"]).groupBy("src", "bucket")
             .agg(F.first("before").alias("before"), F.min("b").alias("b0"),
                  F.transform(F.sort_array(F.collect_list(F.struct("b", "slot"))), lambda x: x["slot"]).alias("slots"))
             .checkpoint())
    place = F.row_number().over(Window.partitionBy("src", "bucket").orderBy("h", F.xxhash64("row", F.lit(1))))
    numbered = (bucketed.withColumn("place", place).join(found, ["src", "bucket"])
                .withColumn("at", F.col("before") + F.col("place") - 1)
                .withColumn("block", F.expr(f"at div {block_rows}"))
                .withColumn("slot", F.expr("slots[cast(block - b0 as int)]")))
    blocks = targets.agg(F.sum(F.ceil(F.col("n") / block_rows))).first()[0]
    return numbered.select("row", "block", "slot", F.expr(f"slot * {block_rows} + at % {block_rows}")
                           .alias("position")), int(blocks or 0)


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
                    **options) -> DataFrame:
    """``docs`` in mixed order: written out, its files follow one another in
    order of position; all rows, columns unchanged."""
    placed, blocks = _mix(docs, weights, block_rows=block_rows, **options)
    parts = shuffle_partitions(docs.sparkSession)
    part = F.expr(f"cast(position * {parts} div {max(1, blocks * block_rows)} as int)")
    return placed.repartitionById(parts, part).sortWithinPartitions("position").select("row.*")
