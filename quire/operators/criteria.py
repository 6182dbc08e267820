"""N-gram index for "contains" criteria on title, author and language.

Every distinct lower-cased value of a field has one row for each distinct gram of one, two and
three characters in it (and one for the empty gram, so that an empty criterion finds every value).  A
criterion is answered from its own grams: three characters each, or the whole criterion if it
is shorter.  Values that hold all of them are candidates, and ``contains`` on the value decides.

``key`` is a hash of the value; two values under one key are both checked, so it decides nothing.
``slot`` deals keys (of values) and grams over folders, of which a lookup opens those it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_CRITERIA = ("title", "author", "language")
GRAM = 3
VALUES_SCHEMA = "key BIGINT, value STRING, book_id BIGINT, field STRING, slot INT"
GRAMS_SCHEMA = "gram STRING, key BIGINT, field STRING, slot INT"


@dataclass(frozen=True)
class CriteriaIndex:
    """``values`` (field, slot, key, value, book_id), ``grams`` (field, slot, gram, key), in ``slots`` slots."""

    values: DataFrame
    grams: DataFrame
    slots: int


def _grams(text: Column, n: int) -> Column:
    """All ``n``-character substrings; empty for shorter texts.  The text is cut into characters once (bound as
    the variable of a lambda), as ``substring`` walks it from its start each time."""
    whole = F.sequence(F.lit(0), F.length(text) - n)
    grams = lambda chars: F.transform(whole, lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))
    return F.when(F.length(text) >= n, F.flatten(F.transform(F.array(F.split(text, "")), grams))) \
        .otherwise(F.array().cast("array<string>"))


def criterion_grams(criterion: Column) -> Column:
    """Grams that every value holding the criterion has; null for no criterion."""
    low = F.lower(criterion)
    return F.when(F.length(low) < GRAM, F.array(low)).otherwise(F.array_distinct(_grams(low, GRAM)))


def slot_of(what: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(what), F.lit(slots)).cast("int")


def field_values(catalog: DataFrame, slots: int) -> DataFrame:
    """(field, slot, key, value, book_id): the lower-cased values of every book; nulls have none."""
    rows = catalog.select("book_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lower(f).alias("value")) for f in TEXT_CRITERIA])).alias("v"))
    key = F.xxhash64("v.field", "v.value")
    return rows.filter(F.col("v.value").isNotNull() & F.col("book_id").isNotNull()).select(
        "v.field", slot_of(key, slots).alias("slot"), key.alias("key"), "v.value", "book_id")


def value_grams(values: DataFrame, slots: int) -> DataFrame:
    """(field, slot, gram, key): the distinct grams of every distinct value.

    Values are few bytes next to their grams, so adaptive execution would put them into one task: they
    are dealt by number.  A key has its values in one row, so its grams need no aggregate."""
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = values.groupBy("field", "key").agg(F.collect_set("value").alias("held")).repartition(tasks, "key")
    of_value = lambda v: F.concat(F.array(F.lit("")), *[_grams(v, n) for n in range(1, GRAM + 1)])
    grams = F.array_distinct(F.flatten(F.transform("held", of_value)))
    out = held.select("field", "key", F.explode(grams).alias("gram"))
    return out.select("field", slot_of(F.col("gram"), slots).alias("slot"), "gram", "key")


def index_of_catalog(catalog: DataFrame) -> CriteriaIndex:
    """An index over a catalogue that is not stored."""
    values = field_values(catalog, 1)
    return CriteriaIndex(values, value_grams(values, 1), 1)


def books_containing(index: CriteriaIndex, criteria: DataFrame) -> DataFrame:
    """(field, criterion, book_id) for a table (field, criterion): the books whose field contains the
    criterion, whatever the case.  Null criteria give no row; repeated ones count once."""
    asked = criteria.filter(F.col("criterion").isNotNull()).select("field", "criterion").distinct() \
        .withColumn("grams", criterion_grams(F.col("criterion")))
    probes = asked.select("field", "criterion", F.size("grams").alias("n"), F.explode("grams").alias("gram")) \
        .withColumn("slot", slot_of(F.col("gram"), index.slots))
    keys = (probes.join(index.grams, ["field", "slot", "gram"]).groupBy("field", "criterion", "key", "n")
            .agg(F.count("*").alias("held")).filter(F.col("held") == F.col("n"))
            .select("field", "criterion", "key", slot_of(F.col("key"), index.slots).alias("slot")))
    return (keys.join(index.values, ["field", "slot", "key"])
            .filter(F.col("value").contains(F.lower("criterion")))
            .select("field", "criterion", "book_id").distinct())


def books_with_text(index: CriteriaIndex, field: str, criterion: str) -> DataFrame:
    """(book_id) of books whose ``field`` contains one literal criterion.  Only the slots of its grams
    are read, and then only the slots of values that hold them all; of these, the slot numbers, at
    most ``index.slots``, come to the driver."""
    spark = index.values.sparkSession
    told = spark.range(1).select(criterion_grams(F.lit(criterion)).alias("g")).select(
        "g", F.transform("g", lambda g: slot_of(g, index.slots)).alias("s")).first()
    grams = index.grams.filter((F.col("field") == field) & F.col("slot").isin(sorted(set(told["s"])))
                               & F.col("gram").isin(told["g"]))
    keys = (grams.groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") == len(told["g"]))
            .select("key"))
    slots = [r["slot"] for r in keys.select(slot_of(F.col("key"), index.slots).alias("slot")).distinct().collect()]
    near = index.values.filter((F.col("field") == field) & F.col("slot").isin(slots))
    return (near.join(keys, "key", "left_semi").filter(F.col("value").contains(F.lower(F.lit(criterion))))
            .select("book_id").distinct())
