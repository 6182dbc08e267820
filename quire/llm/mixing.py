"""Temperature mixing of sources, realised as budgeted block permutations.

Source weights are w_s ~ p_s ** alpha, p_s the source's share of all tokens.  alpha in
[0, 1] is found by bisection: the one that meets a target entropy, or the flattest one for
which no source is repeated more often than a limit.  Entropy falls, and the repetition of
small sources falls, as alpha grows, so both are monotone.

The budget is a number of tokens; without one it is the least that reads every document at
least once.  A source's documents, in an order drawn by hash and anew for every epoch, form one
long stream; block b takes the next w_s * block_tokens tokens of every stream.  A document
belongs to the block in which it starts, at the position within the block that spreads each
source evenly.  (block, position, source, doc) is a total order; sort by it to read.

Streams are cut into bins by hash; token sums of bins are combined before they are shuffled,
their prefix sums give each bin its offset, and a window adds up only inside a bin.  So a source with
most of the rows is dealt over many tasks.  The source table stays a DataFrame: the driver sees
sums over it.

Places are computed on a slim frame of row numbers, hashes and token counts and joined to the rows
by number.  The order comes from a hash of the row's columns (maps left out) and, among rows equal in all of
them, of their running number: rows without id or of one repeated id are spread like all others, equal
rows have places of their own, and the order of the input does not matter.  Running numbers are counted
inside the files or parts of the input and offset by prefix sums over parts, so that no group of equal rows meets in one task.

Null sources are one source of their own.  Null texts have no tokens; a source without any
tokens has weight 0 and each of its documents appears once, in block 0.  Input columns named like the added
ones are replaced, other names are untouched.  An empty table gives no rows.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import identified, staged

#: documents in a bin, about
BIN_ROWS = 4096
ADDED = ("block", "position", "epoch", "n_tokens")


def word_count(text: Column) -> Column:
    """Words between ASCII white space, as tokens of a text; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def _sums(sources: DataFrame, alpha: float) -> tuple[float, float, float]:
    """(sum of p^a, sum of p^a log p, largest p^a / p) over sources with tokens."""
    power = F.pow("p", F.lit(alpha))
    row = sources.agg(F.sum(power), F.sum(power * F.log("p")), F.max(power / F.col("p")), F.min(power / F.col("p"))).first()
    return tuple(row)


def entropy(sums: tuple, alpha: float) -> float:
    """Of the weights p^a / z: log z - a * (sum p^a log p) / z."""
    return log(sums[0]) - alpha * sums[1] / sums[0]


def repetition(sums: tuple, budget_share: float | None) -> float:
    """Most epochs of a source; with no budget, when every source is read at least once."""
    return sums[2] / sums[3] if budget_share is None else budget_share * sums[2] / sums[0]


def find_alpha(sources: DataFrame, target_entropy: float | None, max_repetition: float | None,
               budget_share: float | None = None, steps: int = 24) -> float:
    """Bisect the exponent over ``sources(p)``; 1 (no flattening) if nothing smaller will do."""
    def too_flat(alpha: float) -> bool:
        sums = _sums(sources, alpha)
        return ((target_entropy is not None and entropy(sums, alpha) > target_entropy)
                or (max_repetition is not None and repetition(sums, budget_share) > max_repetition))

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def source_weights(tokens: DataFrame, target_entropy: float | None = None, max_repetition: float | None = 2.0,
                   budget: int | None = None) -> tuple[DataFrame, float, float]:
    """((source, total, docs, weight), alpha, budget) from ``tokens(source, n_tokens)``."""
    per = staged(tokens.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("docs")), "sources")
    everything = per.agg(F.sum("total")).first()[0] or 0
    shares = per.filter("total > 0").select("source", (F.col("total") / F.lit(float(everything or 1))).alias("p"))
    if not everything:
        return per.withColumn("weight", F.lit(0.0)), 1.0, 0.0
    shares = staged(shares, "shares")
    alpha = find_alpha(shares, target_entropy, max_repetition, None if budget is None else budget / everything)
    sums = _sums(shares, alpha)
    if budget is None:                     # least B with B * w_s >= T_s for every source
        budget = everything * sums[0] / sums[3]
    share = F.col("total") / F.lit(float(everything))
    weight = F.when(F.col("total") > 0, F.pow(share, F.lit(alpha)) / F.lit(sums[0])).otherwise(0.0)
    return per.withColumn("weight", weight), alpha, float(budget)


def _numbered_twins(slim: DataFrame) -> DataFrame:
    """``slim`` (row, h1, h2, ...) with ``nth``, the running number of a row among those of equal hashes."""
    # the file of the row, or the task that numbered it
    file = isinstance(slim.schema["row"].dataType, T.StructType)
    slim = slim.withColumn("part", F.col("row.file") if file else F.shiftrightunsigned("row", 33))
    same, first = Window.partitionBy("h1", "h2", "part"), Window.partitionBy("h1", "h2").orderBy("part")
    starts = staged(slim.groupBy("h1", "h2", "part").agg(F.count("*").alias("n")).select(
        "h1", "h2", "part", (F.sum("n").over(first) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy("h1", "h2")).alias("all"))
        .filter("all > 1").drop("all"), "twins")
    counted = slim.join(starts, ["h1", "h2", "part"], "left")
    alone = counted.filter("start is null").withColumn("nth", F.lit(0).cast("bigint"))
    twins = counted.filter("start is not null").withColumn("nth", F.col("start") + F.row_number().over(same.orderBy("row")) - 1)
    return alone.unionByName(twins).drop("part", "start")


def mix(docs: DataFrame, source: str = "source", text: str = "text", tokens: Column | None = None,
        target_entropy: float | None = None, max_repetition: float | None = 2.0, budget: int | None = None,
        block_tokens: int = 1 << 20, seed: int = 7, bin_rows: int = BIN_ROWS) -> DataFrame:
    """Rows of ``docs``, once for every time they are read, with block, position, epoch and n_tokens.

    ``tokens`` is a column expression over ``docs``; without it the words of ``text`` are counted."""
    names = [c for c in docs.columns if c.lower() not in ADDED]
    rows, number = identified(docs, "numbered-documents")
    hashed = [rows[f.name] for f in rows.schema if f.name in names and not isinstance(f.dataType, T.MapType)]
    hashed += [c.isNull() for c in hashed]
    # a source as a string that is never null
    slim = staged(rows.select(
        F.col(number).alias("row"), F.xxhash64(*hashed).alias("h1"), F.xxhash64(F.lit(1), *hashed).alias("h2"),
        F.coalesce(F.concat(F.lit("="), rows[source].cast("string")), F.lit("")).alias("source"),
        F.coalesce((word_count(rows[text].cast("string")) if tokens is None else tokens).cast("bigint"), F.lit(0)).alias("n_tokens")), "counts")
    weights, _, budget = source_weights(slim.select("source", "n_tokens"), target_entropy, max_repetition, budget)
    # written, so that its size is known: Spark broadcasts it if small and splits hot sources if not
    target = F.col("weight") * F.lit(budget)
    plan = staged(weights.select(
        "source", "total", (F.col("weight") * block_tokens).alias("quota"), target.alias("target"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / bin_rows)).cast("bigint").alias("bins"),
        F.when(F.col("total") > 0, F.ceil(F.round(target / F.col("total"), 9))).otherwise(1).cast("int").alias("epochs")), "plan")

    # one row a reading, with its bin: some bits of the hash that orders the epoch
    order = F.xxhash64("h1", "h2", "nth", "epoch", F.lit(seed))
    each = staged(_numbered_twins(slim).join(plan.select("source", "bins", "epochs"), "source").filter("epochs > 0")
                  .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))).withColumn("order", order)
                  .withColumn("bin", F.pmod(F.shiftrightunsigned("order", 20), F.col("bins"))).drop("bins", "epochs"), "readings")
    keys = ["source", "epoch", "bin"]
    sums = each.groupBy(*keys).agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("epoch", "bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    inside = Window.partitionBy(*keys).orderBy("order", "h1", "h2", "nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = (each.withColumn("in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(offsets, keys).join(plan.select("source", "total", "quota", "target"), "source"))
    at = F.col("offset") + F.col("in")
    share = at / F.col("quota")
    block = F.when(F.col("quota") > 0, F.floor(share)).otherwise(0).cast("bigint")
    position = F.when(F.col("quota") > 0, share - F.floor(share)).otherwise(0.0)
    unread = (F.col("epoch") == 0) & (F.col("n_tokens") == 0) & (F.round(F.col("target") - F.col("total"), 3) >= 0)
    read = placed.filter((at < F.round(F.col("target"), 3)) | (F.col("total") == 0) | unread).select(
        F.col("row").alias(number), block.alias("block"), position.alias("position"), "epoch", "n_tokens")
    return rows.select(number, *names).join(read, number).select(*names, *ADDED)
