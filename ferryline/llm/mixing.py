"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. A source with ``share`` of every
``period`` slots releases its block b (from 0) at slot ``floor(b*period/share)``,
with the deadline ``ceil((b+1)*period/share)``; earliest deadline first, among
released blocks, fills one slot after another. The shares add up to the period, so
every deadline is met and after any number of slots each source is within one block
of its share. A share differs from the target weight by less than one slot in a period, so
against the target a source may be off by one block more in every period. Integer shares make the schedule repeat after one period, so only one
period is computed, and the slot of any block follows by arithmetic, in parallel.

When the schedule calls for a source that has no block left, a new phase begins in that
slot: shares, releases and deadlines start anew for the sources that still have blocks. So
the mix goes on to the last document. Phases follow from the counts alone; one row folds
them, at most one for each of ``HEADS`` + 2 sources.

Sources beyond the ``HEADS`` heaviest, and those with less than one slot in a period, are
scheduled together as one, with the sum of their weights; their blocks stand in the order of
``(block + offset) / weight`` (fair queueing; the offset spreads sources of one weight). So there may be any
number of sources. Inside that pool a source may be off by more than a block. Sources without weight
come after everything else, and only they are not ``in_mix``.

The order within a source is that of md5(id). Rows are ranked within (source, leading
digits of the md5) and the counts of the groups before are added, so a source with a
third of all rows is ranked by many tasks.

Results for odd input: a NULL source is a source of its own; NULL ids come first;
repeated rows take neighbouring places; every row is returned and every slot filled.
Empty input gives no rows. Input columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferryline.llm.rows import as_doc, col, positions, unpacked
from ferryline.shared import materialize

PERIOD = 1024
BLOCK_DOCS = 8
#: Sources that are scheduled by themselves, the others as one; bounds the fold over phases.
HEADS = 126
#: Rows that a ranking group should hold; decides how many digits of the md5 group.
GROUP_ROWS = 20_000
#: Blocks of a pooled source that one row lists.
RUN = 10_000
#: Numbers of the pools of light sources and of sources without weight.
LIGHT, NO_WEIGHT = 1_000_000, 1_000_001

ADDED = ("share", "phase", "block", "release", "deadline", "slot", "in_mix")


def _key(source: str) -> Column:
    """The source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("")).alias("key")


def weighed_sources(df: DataFrame, source: str = "source", weights: dict[str, float] | None = None,
                    period: int = PERIOD, block_docs: int = BLOCK_DOCS, heads: int = HEADS) -> DataFrame:
    """Stored rows ``(key, blocks, w, entity)``: the number under which each source is scheduled.

    Without ``weights`` the target is the square root of the source's number of rows.
    """
    counts = df.select(_key(source)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.floor(F.sqrt("n") * 1000)
    else:
        scaled = {"" if k is None else f"={k}": int(v * 1_000_000) for k, v in weights.items()}
        given = F.create_map(*[F.lit(x) for pair in scaled.items() for x in pair])
        weight = F.coalesce(F.try_element_at(given, F.col("key")), F.lit(0)) if scaled else F.lit(0)
    counts = materialize(counts.select(
        "key", F.ceil(F.col("n") / block_docs).cast("bigint").alias("blocks"), weight.cast("bigint").alias("w")),
        "sources")
    w_all = counts.agg(F.sum("w")).first()[0] or 0
    # At most `heads` rows: one task can number them.
    first = counts.where((F.col("w") > 0) & ((period - 1) * F.col("w") >= w_all)).orderBy(
        F.desc("w"), "key").limit(heads).select("key", "w")
    first = first.select("key", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy("key")).cast("bigint").alias("head"))
    return materialize(counts.join(F.broadcast(first), "key", "left").select("key", "blocks", "w", F.coalesce(
        "head", F.when(F.col("w") > 0, F.lit(LIGHT)).otherwise(F.lit(NO_WEIGHT)).cast("bigint")).alias("entity")),
        "entities")


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _order_sql(period: int) -> str:
    """The places in ``share`` that fill the slots of one period, earliest deadline first."""
    best = (f"array_min(transform(st.done, (d, x) -> IF(d * {period} < (t + 1) * share[x], struct("
            f"((d + 1) * {period} + share[x] - 1) div share[x] AS deadline, x AS x), NULL))).x")
    step = _let(best, "b", "named_struct('done', transform(st.done, (d, x) -> d + CAST(x = b AS BIGINT)), "
                           "'order', concat(st.order, array(b)))")
    return (f"aggregate(sequence(0, {period - 1}), named_struct('done', transform(share, s -> 0L), "
            f"'order', CAST(array() AS ARRAY<INT>)), (st, t) -> {step}, st -> st.order)")


def _phase_sql(period: int) -> str:
    """State after the next phase, from state ``s`` and entities ``e``."""
    has = "e[{0}].blocks > s.done[{0}]"
    live = (f"filter(sequence(0, size(e) - 1), i -> {has.format('i')} AND (e[i].w > 0 OR NOT exists("
            f"sequence(0, size(e) - 1), j -> e[j].w > 0 AND {has.format('j')})))")
    base = f"transform(live, i -> IF(w_all = 0, {period}L, greatest(1L, {period - 1} * e[i].w div w_all)))"
    more = (f"transform(slice(array_sort(transform(live, (i, x) -> struct(-({period - 1} * e[i].w % "
            f"greatest(w_all, 1L)) AS r, x AS x))), 1, greatest(0, CAST({period} - "
            "aggregate(base, 0L, (a, b) -> a + b) AS INT))), r -> r.x)")
    share = "transform(base, (b, x) -> b + CAST(array_contains(more, x) AS BIGINT))"
    ats = f"transform(share, (p, x) -> filter(sequence(0, {period - 1}), t -> order[t] = x))"
    end = _let("e[i].blocks - s.done[i]", "r", f"r div share[x] * {period} + ats[x][CAST(r % share[x] AS INT)]")
    ends = f"array_min(transform(live, (i, x) -> {end}))"
    took = (f"transform(live, (i, x) -> h div {period} * share[x] + "
            f"size(filter(ats[x], t -> t < h % {period})))")
    done = ("transform(s.done, (d, i) -> d + IF(array_contains(live, i), "
            "took[CAST(array_position(live, i) - 1 AS INT)], 0L))")
    plans = ("concat(s.plans, transform(live, (i, x) -> named_struct('entity', e[i].entity, 'phase', p, "
             "'share', share[x], 'base', s.done[i], 'upto', s.done[i] + took[x], 'start', s.start, 'ats', ats[x])))")
    body = f"named_struct('start', s.start + h, 'done', {done}, 'plans', {plans})"
    for value, name in ((took, "took"), (ends, "h"), (ats, "ats"), (_order_sql(period), "order"), (share, "share"),
                        (more, "more"), (base, "base"), ("aggregate(live, 0L, (a, i) -> a + e[i].w)", "w_all")):
        body = _let(value, name, body)
    return _let(live, "live", f"IF(size(live) = 0, s, {body})")


PLAN_TYPE = ("ARRAY<STRUCT<entity: BIGINT, phase: INT, share: BIGINT, base: BIGINT, upto: BIGINT, "
             "start: BIGINT, ats: ARRAY<INT>>>")


def phases(entities: DataFrame, period: int = PERIOD) -> DataFrame:
    """From ``(entity, blocks, w)`` rows ``(entity, phase, share, base, upto, start, ats)``.

    Blocks ``base`` to ``upto`` (exclusive) of an entity run in the phase that begins at slot
    ``start``; its j-th block in a period takes slot ``ats[j]`` of it.
    """
    one = entities.agg(F.array_sort(F.collect_list(F.struct("entity", "blocks", "w"))).alias("e"))
    begin = f"named_struct('start', 0L, 'done', transform(e, x -> 0L), 'plans', CAST(array() AS {PLAN_TYPE}))"
    folded = (f"aggregate(sequence(1, size(e)), {begin}, (s, p) -> {_phase_sql(period)}, s -> s.plans)")
    return one.where(F.size("e") > 0).select(F.explode(F.expr(folded)).alias("p")).select("p.*")


def pool_places(sources: DataFrame) -> DataFrame:
    """``(key, block, entity, at)``: the place of each block of a pooled source in its pool."""
    offset = F.pmod(F.xxhash64("key"), F.lit(1024)) / 1024
    # In runs of blocks, so that no row holds, and no task lists, all blocks of a long source.
    runs = sources.where(F.col("entity") >= LIGHT).select(
        "key", "entity", "w", "blocks", offset.alias("offset"),
        F.explode(F.expr(f"sequence(0L, (blocks - 1) div {RUN})")).alias("run")).repartition("key", "run")
    blocks = runs.select("key", "entity", "w", "offset", F.explode(F.expr(
        f"sequence(run * {RUN}, least(blocks, (run + 1) * {RUN}) - 1)")).alias("block"))
    due = ((F.col("block") + F.col("offset")) / F.greatest("w", F.lit(1))).alias("due")
    return positions(blocks.select("entity", "key", "block", due), ["entity"], ["due", "key", "block"], "pool").select(
        "key", "block", "entity", F.col("pos").alias("at"))


def mix(df: DataFrame, source: str = "source", doc_id: str = "doc_id",
        weights: dict[str, float] | None = None, period: int = PERIOD,
        block_docs: int = BLOCK_DOCS, heads: int = HEADS) -> DataFrame:
    """``df`` with share, phase, block, release, deadline, slot and in_mix of every row.

    ``block`` counts within the source, ``share`` is that of the source or of its pool.
    """
    sources = weighed_sources(df, source, weights, period, block_docs, heads)
    pooled = bool(sources.where(F.col("entity") >= LIGHT).limit(1).count())
    plan = materialize(phases(sources.groupBy("entity").agg(
        F.sum("blocks").alias("blocks"), F.sum("w").alias("w")), period), "plan")
    rows_in_all = block_docs * (sources.agg(F.sum("blocks")).first()[0] or 0)
    digits = 1
    while digits < 8 and rows_in_all > GROUP_ROWS * 16**digits:
        digits += 1

    digest = F.md5(F.coalesce(col(doc_id).cast("string"), F.lit("")))
    # Rank and join share one shuffle of the rows, by the same keys.
    key = _key(source)
    part = F.substring(digest, 1, digits).alias("part")
    rows = df.select(as_doc(df), key, digest.alias("digest"), part)
    sizes = df.select(key, part).groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("key", "part", (F.sum("size").over(
        Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )).alias("before"))
    ranked = rows.withColumn("within", F.row_number().over(
        Window.partitionBy("key", "part").orderBy(
            "digest", F.col("doc").getField(doc_id).asc_nulls_first())) - 1)
    placed = ranked.join(before, ["key", "part"]).select(
        "doc", "key", F.expr(f"(within + coalesce(before, 0)) div {block_docs}").alias("block"))
    # Heads are few; a source that is not among them belongs to a pool.
    of_head = F.broadcast(sources.where(F.col("entity") < LIGHT).select("key", "entity"))
    if pooled:
        placed = placed.join(of_head, "key", "left")
        in_pool = placed.where("entity IS NULL").drop("entity").join(pool_places(sources), ["key", "block"])
        placed = placed.where("entity IS NOT NULL").withColumn("at", F.col("block")).unionByName(in_pool)
    else:
        placed = placed.join(of_head, "key").withColumn("at", F.col("block"))
    phase = F.broadcast(plan.withColumnRenamed("entity", "p_entity"))
    timed = placed.join(phase, (F.col("entity") == F.col("p_entity")) & (F.col("at") >= F.col("base"))
                        & (F.col("at") < F.col("upto"))).withColumn("b", F.col("at") - F.col("base"))
    slotted = timed.select(
        "doc", "share", "phase", "block",
        F.expr(f"start + b * {period} div share").alias("release"),
        F.expr(f"start + ((b + 1) * {period} + share - 1) div share").alias("deadline"),
        (F.expr(f"start + b div share * {period}")
         + F.get("ats", (F.col("b") % F.col("share")).cast("int"))).alias("slot"),
        (F.col("entity") != NO_WEIGHT).alias("in_mix"))
    return slotted.select(*unpacked([c for c in df.columns if c.lower() not in ADDED]),
                          *[F.col(c) for c in ADDED])
