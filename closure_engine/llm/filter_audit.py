"""Filter interaction audit: what each order of a set of filters removes, step by step.

A filter is a named condition under which a document fails.  Every document has
a mask of the filters that it fails, and all that an order of filters does
follows from how many documents each (part, mask) cell holds.  The cells are
counted once; a recursive CTE then enumerates the orders: it starts from the
empty prefix joined with the masks that occur, and every level extends each
prefix by the letters whose bit is not yet applied, carries the applied bits and
emits what that step does to each mask's cell (keeps, removes, finds removed
before).  As the recursion knows masks and not parts, it has at most 326
prefixes times 32 masks for five filters, whatever the number of documents and
parts, and that bound is what lets its rows be broadcast to the counted cells.

The duplicate filter compares texts table-wide: the smallest id of every SHA-256
digest of a text is a partial aggregate, and the rows find it by an equi-join on
(digest, id), so the copies of one text are spread by their ids.  Rows that agree
in id, text and part are one row with a count before anything is shuffled.

Results: a null text is empty (it fails the length filter and is equal to every
other empty text; the vocabulary and capital filters compare 0 with 0, so it
passes them).  A null source and an empty one are the same part.  Repeated rows
count one by one; two rows with the same id and text are not smaller than each
other, so neither fails the duplicate filter through the other.  A null id is
not compared: its row never fails that filter and makes none fail.  An id with
several label rows counts as good or toxic if any of them says so, one without
labels as neither.  Only id, text, source and the two labels are read, so other
columns can't clash.  An empty table has no part and gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closure_engine.operators.skew import skew_safe_lookup

from .common import WORD, written


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions by letter that look at one text, whose nulls are already empty."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _spread_lookup(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the labels of their id; an id that holds many rows doesn't meet them in one task."""
    return skew_safe_lookup(rows, labels, "id", "left")


def mask_cells(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None, duplicates: str | None = "E",
               id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", good_col: str = "quality",
               toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters, bit i for the i-th letter.

    ``conditions``: failure conditions over the column ``text``; ``duplicates``
    names the last filter, which fails texts that a smaller id also has.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    conditions = text_filters(F.col("text")) if conditions is None else conditions
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("mask"))
    rows = written(rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")), "audit-rows")
    if duplicates:
        lowest = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id is not null").withColumn("lowest", F.lit(True))
        later = F.col("id").isNotNull() & F.col("lowest").isNull()
        rows = rows.join(lowest, ["digest", "id"], "left").withColumn("mask", F.col("mask") + F.when(later, 1 << len(conditions)).otherwise(0))
    one = lambda c: F.max((F.col(c) == 1).cast("int"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(one(good_col).alias("good"), one(toxic_col).alias("toxic"))
    held = _spread_lookup(rows.select("id", "part", "mask", "n"), marks)
    marked = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c)
    return held.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("good"), marked("toxic"))


#: {values}: the letters that a set of applied filters leaves, with their bits; {cells}: the counted cells.  A level's rows
#: are (prefix, mask) pairs.
_ENUMERATE = """WITH RECURSIVE unused(applied, letter, bit) AS (VALUES {values}),
steps(filter_prefix, letter, bit, step, applied, mask, keeps, removes, late) AS (
  SELECT CAST('' AS STRING), CAST('' AS STRING), 0, 0, 0, mask, true, false, false FROM (SELECT DISTINCT mask FROM {cells})
  UNION ALL
  SELECT concat(s.filter_prefix, l.letter), l.letter, l.bit, s.step + 1, s.applied | l.bit, s.mask, s.mask & (s.applied | l.bit) = 0,
         s.mask & l.bit <> 0 AND s.mask & s.applied = 0, s.mask & l.bit <> 0 AND s.mask & s.applied <> 0
  FROM steps s JOIN unused l ON l.applied = s.applied
)
SELECT filter_prefix, letter, step, mask, keeps, removes, late, mask = bit AS alone FROM steps WHERE step > 0"""


def filter_orders(cells: DataFrame, letters: str) -> DataFrame:
    """(filter_prefix, letter, step, mask, keeps, removes, late, alone): what every step of every order does to a mask."""
    unused = [(applied, x, 1 << i) for applied in range(1 << len(letters)) for i, x in enumerate(letters) if not applied >> i & 1]
    values = ", ".join(f"({applied}, '{x}', {bit})" for applied, x, bit in unused)
    return cells.sparkSession.sql(_ENUMERATE.replace("{values}", values), cells=cells)


def filter_audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None, duplicates: str | None = "E", **columns) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` adds up what the step's filter removes, at any step, over all
    orders (its Shapley value times their number).  ``conditions``: at most six
    failure conditions over ``text`` by a letter each (default: :func:`text_filters`).
    """
    names = list(text_filters(F.lit("")) if conditions is None else conditions) + [duplicates] * bool(duplicates)
    letters = "".join(names)
    if len(letters) > 6 or any(len(x) != 1 for x in names) or len(set(letters)) != len(letters):
        raise ValueError("at most six filters, each named by one letter of its own")
    cells = written(mask_cells(docs, labels, conditions, duplicates, **columns), "audit-cells")
    steps = written(filter_orders(cells, letters), "audit-steps")  # at most 1957 prefixes times 64 masks
    total = lambda flag, of, name: F.sum(F.when(F.col(flag), F.col(of)).otherwise(0)).alias(name)
    metrics = cells.join(F.broadcast(steps), "mask").groupBy("part", "filter_prefix", "letter", "step").agg(
        total("keeps", "n", "kept"), total("removes", "n", "removed"), total("late", "n", "redundant"), total("alone", "n", "unique_fails"),
        total("removes", "good", "good_lost"), total("removes", "toxic", "toxic_lost"))
    metrics = written(metrics, "audit-metrics")
    orders_after = F.factorial(F.lit(len(letters)) - F.col("step"))  # whole orders that begin with the prefix
    shapley = metrics.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_after).alias("shapley"))
    whole = steps.where(F.col("step") == len(letters)).select(F.col("filter_prefix").alias("filter_order")).distinct()
    prefixes = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    prefixes = prefixes.withColumn("filter_prefix", F.substring("filter_order", F.lit(1), F.col("step")))  # at most 720 orders
    return (metrics.join(shapley, ["part", "letter"]).join(F.broadcast(prefixes.drop("step")), "filter_prefix")
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
