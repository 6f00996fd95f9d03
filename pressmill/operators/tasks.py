"""Choosing and spreading work."""

from heapq import heapify, heapreplace

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pressmill.functions.rules import label
from pressmill.functions.rule_values import NOT_ENGLISH
from pressmill.operators.numbering import add_totals_before, in_order, number_rows
from pressmill.session import write_between

# limits up to here are the top of the partitions' tops
SMALL_LIMIT = 5_000
# a site is heavy if it holds at least this part of a block's fair share
HEAVY_PARTS = 8


def fetch_tasks(articles: DataFrame, batch_id: Column | int | None = None, status: str | None = None,
                limit: int = 0, fields: list[str] | None = None,
                order: str = "article_id") -> DataFrame:
    """Rows of a status and batch; no batch or no status means any, limit 0 means all.

    Exactly ``limit`` rows are taken, or all if there are fewer: those of the lowest
    ids, nulls first; of rows with one id any may be cut off.  For a small limit they
    are the top of each partition's top; see `lowest_rows` for a large one.
    """
    if status:
        articles = articles.filter(F.col("status") == status)
    if isinstance(batch_id, Column) or batch_id:
        articles = articles.filter(F.col("batch_id") == batch_id)
    tasks = articles.select(order, *[f for f in fields or [] if f != order]) if fields else articles
    if not limit:
        return tasks
    if limit > SMALL_LIMIT:
        return lowest_rows(tasks, order, limit)
    return tasks.orderBy(F.col(order).asc_nulls_first()).limit(limit)


def lowest_rows(rows: DataFrame, order: str, limit: int) -> DataFrame:
    """Exactly the ``limit`` rows of the lowest ``order``, nulls first, or all if there are fewer.

    The values alone are dealt into ranges and counted, which tells the range where
    the limit falls and the value in it; the rows below that value are then a filter,
    and no task gets more than one range.  Of the rows that have the value itself some
    are taken by their place in the input, so ``rows`` must read the same twice.
    """
    ranged = in_order(rows.select(F.col(order).alias("_key")), F.col("_key").asc_nulls_first())
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    numbered = add_totals_before(ranged, sizes, "_size", []).withColumn("_position", F.col("_before") + F.col("_at"))
    cut = numbered.filter(F.col("_position") == limit - 1).select("_key").first()
    if cut is None:
        return rows
    value = F.lit(cut[0]).cast(rows.schema[order].dataType)
    least, last = numbered.filter(F.col("_key").eqNullSafe(value)).agg(F.min("_position"), F.max("_position")).first()
    known = F.col(order).isNull() if cut[0] is not None else F.lit(False)
    below = rows.filter(known | F.coalesce(F.col(order) < value, F.lit(False)))
    equal = rows.filter(F.col(order).eqNullSafe(value))
    if last >= limit:
        some = number_rows(equal.withColumn("_row", F.monotonically_increasing_id()), "_row", name="_position")
        equal = some.filter(F.col("_position") < limit - least).select(*rows.columns)
    return below.unionByName(equal)


def retry_filter(tasks: DataFrame, max_retries: int = 5) -> DataFrame:
    """Tasks tried at most ``max_retries`` times (0 = any).  Apply after the limit."""
    if not max_retries:
        return tasks
    return tasks.filter(F.coalesce("tries", F.lit(0)) <= max_retries)


def draw(key: Column, seed: int) -> Column:
    """A repeatable pseudo-random number below 2**60 for a key.

    Taken from a digest of the key, so it does not depend on partitioning and
    any SQL engine can repeat it.
    """
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def shuffle_tasks(tasks: DataFrame, seed: int, key: str = "article_id") -> DataFrame:
    """Random order by the added ``draw``, the same for a seed on any partitioning."""
    return tasks.withColumn("draw", draw(F.col(key), seed)).orderBy("draw", key)


def site_blocks(tasks: DataFrame, n: int, site: str = "media_url") -> DataFrame:
    """One row per site: ``n_tasks``, ``position`` by falling size, ``block``.

    Sites are dealt out by size, to the blocks in turn and back again, so that
    blocks differ by at most the tasks of the largest site.  Only site names and
    counts are numbered, by one range shuffle.
    """
    sites = tasks.filter(F.col(site) != "").groupBy(site).agg(F.count("*").alias("n_tasks"))
    numbered = number_rows(sites, F.desc("n_tasks"), site)
    turn = F.col("position") % (2 * n)
    return numbered.withColumn("block", F.when(turn < n, turn).otherwise(2 * n - 1 - turn).cast("int"))


def even_site_blocks(tasks: DataFrame, n: int, site: str = "media_url") -> DataFrame:
    """One row per site: ``n_tasks``, ``block``; heavy sites are placed one by one, the others fill up the blocks.

    Heavy sites have at least 1/``HEAVY_PARTS`` of a block's fair share of the tasks, so
    there are at most ``n * HEAVY_PARTS`` of them, whatever the input.  By falling size, then
    name, each goes to the block with the fewest tasks yet, of equal ones to the first.
    The tasks of the other sites, by falling size and name, are laid end to end into the room that
    the blocks have below the level at which all would fit; a site goes where its first
    task falls.  So no block gets more than the larger of what its heavy sites hold and
    that level plus one light site.  A light site's place comes from one range shuffle of
    sites and one sum per range.
    """
    sites = write_between(tasks.filter(F.col(site) != "").groupBy(site).agg(F.count("*").alias("n_tasks")))
    total = sites.agg(F.sum("n_tasks")).first()[0] or 0
    heavy = F.col("n_tasks") * F.lit(n * HEAVY_PARTS) >= F.lit(total)
    loads = [(0, block) for block in range(n)]
    heapify(loads)
    placed = []
    for row in sites.filter(heavy).orderBy(F.desc("n_tasks"), site).collect():
        load, block = loads[0]
        heapreplace(loads, (load + row["n_tasks"], block))
        placed.append((row[site], row["n_tasks"], block))
    by_block = [load for load, _ in sorted(loads, key=lambda x: x[1])]
    ends, end = [], 0
    level = _level(by_block, total - sum(by_block))
    for load in by_block:
        end += max(0, level - load)
        ends.append(end)

    ranged = in_order(sites.filter(~heavy), F.desc("n_tasks"), site)
    here = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("_within", F.coalesce(F.sum("n_tasks").over(here), F.lit(0)))
    sums = ranged.groupBy("_part").agg(F.sum("n_tasks").alias("_sum"))
    start = F.col("_before") + F.col("_within")
    full = F.size(F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e <= start))
    light = add_totals_before(within, sums, "_sum", []).select(site, "n_tasks", full.alias("block"))
    schema = StructType([*sites.schema.fields, StructField("block", IntegerType())])
    return light.unionByName(tasks.sparkSession.createDataFrame(placed, schema))


def _level(loads: list[int], rest: int) -> int:
    """Least level below which blocks of the given loads have room for ``rest`` tasks."""
    below = 0
    ordered = sorted(loads)
    for k, load in enumerate(ordered, 1):
        below += load
        level = -(-(rest + below) // k)
        if k == len(ordered) or level <= ordered[k]:
            return level
    return 0


def assign_blocks(tasks: DataFrame, n: int, site: str = "media_url", even: bool = False) -> DataFrame:
    """Add ``block``: all tasks of a site share one, and blocks are of even size.

    Sites are dealt by `site_blocks`, or by `even_site_blocks`, which reads the sizes first
    and fits a few large sites better.  Tasks without a site drop out, except that a
    single block takes everything.  The join back is left to Spark: it broadcasts the site
    table if its size allows, and AQE splits a site that holds much of the rows.
    """
    if n <= 1:
        return tasks.withColumn("block", F.lit(0))
    blocks = even_site_blocks(tasks, n, site) if even else site_blocks(tasks, n, site)
    return tasks.join(blocks.select(site, "block"), site)


def stripe(tasks: DataFrame, n: int, order: str = "article_id") -> DataFrame:
    """Add ``block``: rows dealt out in turn, row *i* to block *i mod n*."""
    numbered = number_rows(tasks, order, name="_n")
    return numbered.withColumn("block", (F.col("_n") % max(n, 1)).cast("int")).drop("_n")


def gate_label(english_only: bool, language: str = "language") -> Column:
    """Label of a row that is not fetched for its language, else null."""
    refused = F.lit(english_only) & ~F.col(language).eqNullSafe("en")
    return F.when(refused, label(NOT_ENGLISH))


def language_gate(stories: DataFrame, english_only: bool = True, language: str = "language") -> DataFrame:
    """Add ``text``: the label where the language is refused, else null."""
    return stories.withColumn("text", gate_label(english_only, language))


def pause_plan(stories: DataFrame, order: str, min_s: int = 1, max_s: int = 5, seed: int = 0,
               domain: str = "domain", gated: Column | None = None,
               by: str | None = None) -> DataFrame:
    """Add ``pause`` and ``start_offset`` (seconds waited until the row may start).

    A row waits a random whole number of seconds when its domain is that of the
    row before it; the first row is compared with the last.  Gated rows never
    wait but count as the row before.  ``by`` plans each block on its own.

    Neighbours and running sums are found per range of rows; across ranges only
    one last domain and one sum per range are passed on.
    """
    by = [by] if by else []
    gated = F.lit(False) if gated is None else gated
    rows = in_order(stories.withColumn("_gated", gated), *by, order)

    here = Window.partitionBy(*by, "_part").orderBy("_at")
    lasts = rows.groupBy(*by, "_part").agg(F.max_by(domain, "_at").alias("_last"))
    ranges = Window.partitionBy(*by).orderBy("_part")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entering = lasts.select(
        *by, "_part",
        F.when(F.row_number().over(ranges) == 1, F.last("_last").over(whole))
        .otherwise(F.lag("_last").over(ranges)).alias("_entering"),
    )
    pause = (min_s + draw(F.col(order), seed) % (max_s - min_s + 1)).cast("bigint")
    first = F.row_number().over(here) == 1
    previous = F.when(first, F.col("_entering")).otherwise(F.lag(domain).over(here))
    waits = ~F.col("_gated") & F.col(domain).eqNullSafe(previous)
    paused = write_between(
        rows.join(entering, [*by, "_part"])
        .withColumn("pause", F.when(waits, pause).otherwise(F.lit(0)))
        .withColumn("_so_far", F.sum("pause").over(here))
        .drop("_entering")
    )
    sums = paused.groupBy(*by, "_part").agg(F.sum("pause").alias("_sum"))
    return (
        add_totals_before(paused, sums, "_sum", by)
        .withColumn("start_offset", F.col("_before") + F.col("_so_far"))
        .drop("_gated", "_part", "_at", "_so_far", "_before")
    )
