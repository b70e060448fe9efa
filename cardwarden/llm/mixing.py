"""Mixes sources to target weights by capped water-filling, then takes whole and fractional repetitions of documents.

Sources in code point order, the missing one last, weigh 5, 2, 1 in turn and share the words of all documents by weight.
No source is repeated more than three times: what a source can't take is dealt to the others by weight, until none is
above its cap. Each document is then taken as often as its source goes whole into the target; what is left of the target
is taken once more from documents in a seeded order, the last of them only as far as words are left, so that the words
taken of a source are its target, rounded.

DataFrame functions only. The order within a source is never sorted: the key at which the target is reached is found
digit by digit, from sums of sizes per digit, so a source with a third of all rows is summed where its rows lie.

Nulls: a null text has no words, a null source is a source of its own, a null doc_id is a value like any other. Empty texts take
nothing. Very long texts are counted whole. Rows that agree in doc_id and size are told apart by their number, which changes
none of the values returned. An empty table gives no rows; where no document has a word, all targets are 0. Only doc_id,
source and text of documents are read, so other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import drop, ranked, salted_join, small_side, stored

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 13
WORD = r"[^\x20\x09-\x0D]+"

#: Bits of an order key, and those of them that one pass looks at.
KEY_BITS, DIGIT_BITS = 60, 12


def _exact(column: Column | str) -> Column:
    return F.col(column).cast("decimal(19,0)") if isinstance(column, str) else column.cast("decimal(19,0)")


def _key(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("-")) for p in parts])
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(KEY_BITS // 4)), 16, 10).cast("long")


def document_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size in words, `tree` (the source, null told apart), and two order keys. Written once."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = rows.withColumns({
        "tree": F.coalesce(F.concat(F.lit("+"), "source"), F.lit("")),
        "key": _key(F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string")),
        "tie": _key(F.monotonically_increasing_id().cast("string")),
    })
    return stored(rows, "sizes")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """tree, source_size, weight, target of each source.

    Each round clamps the sources whose share by weight is above their cap and deals the rest of the words to the others
    by weight. The share only grows, so a clamped source stays clamped; one row a round reaches the driver.
    """
    sums = sizes.groupBy("tree", "source").agg(F.sum("size").alias("source_size"))
    places = ranked(sums, [F.col("source").asc_nulls_last()], "sources")
    turn = (F.col("place") % len(weights)).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn).cast("long")
    sources = stored(places.select("tree", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * most_epochs
    total, sum_of_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, shared = total or 0, sum_of_weights or 0

    def clamped() -> Column:
        return _exact(cap) * F.lit(shared) <= _exact("weight") * F.lit(rest)

    while shared:
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped(), cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~clamped(), F.col("weight"))), F.lit(0)),
        ).first()
        if (total - row[0], row[1]) == (rest, shared):
            break
        rest, shared = total - row[0], row[1]
    share = F.try_divide((F.col("weight") * F.lit(rest)).cast("double"), F.lit(float(shared)))
    target = F.when(clamped(), cap.cast("double")).otherwise(share) if shared else cap.cast("double")
    return sources.withColumn("target", target)


def _digits(depth: int) -> list[Column]:
    """The first depth digits of the order keys, as one number for each key."""
    out = []
    for name in ("key", "tie"):
        bits = min(KEY_BITS, max(0, depth * DIGIT_BITS))
        out.append(F.shiftright(name, KEY_BITS - bits))
        depth -= bits // DIGIT_BITS
    return out


def _cuts(sizes: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """tree, left, at_key, at_tie, and the depth in digits: the row of each tree at which its first `left` words end.

    wanted: tree, left (at least 1, at most the words of the tree). left of the result: words to take of that row.
    A pass adds one digit to the keys at which the words end, until only one row has them.
    """
    cuts = stored(wanted.select("tree", "left", F.lit(0).cast("long").alias("at_key"), F.lit(0).cast("long").alias("at_tie")), "cuts")
    depth, deepest = 0, 2 * KEY_BITS // DIGIT_BITS
    while depth < deepest:
        in_key, in_tie = _digits(depth)
        joined = _with(sizes, cuts).where((in_key == F.col("at_key")) & (in_tie == F.col("at_tie")))
        next_key, next_tie = _digits(depth + 1)
        sums = joined.groupBy("tree", next_key.alias("at_key"), next_tie.alias("at_tie")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.first("left").alias("left")
        )
        # at most 2 ** DIGIT_BITS rows a tree
        upto = F.sum("words").over(Window.partitionBy("tree").orderBy("at_key", "at_tie"))
        ends = sums.withColumn("upto", upto).where("upto >= left and upto - words < left")
        found = stored(ends.select("tree", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), "at_key", "at_tie", "n"), "cuts")
        drop(cuts)
        cuts, depth = found, depth + 1
        if (found.agg(F.max("n")).first()[0] or 1) == 1:
            break
    return cuts, depth


def _with(sizes: DataFrame, by_tree: DataFrame, how: str = "inner") -> DataFrame:
    """sizes with the columns of a stored table that has a row per tree. A tree may hold a third of all rows."""
    one = small_side(by_tree)
    return sizes.join(one, "tree", how) if one is not by_tree else salted_join(sizes, by_tree, "tree", "tie", how)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, weight of every document.

    taken: words the mix takes of the document, repeats counted; taken div size whole repetitions and, of one document
    a source, the first taken % size words once more. The words taken of a source are its target, rounded half up.
    """
    sizes = document_sizes(docs, seed)
    targets = source_targets(sizes, weights, most_epochs)
    budget = F.floor(F.col("target") + 0.5)
    whole = F.coalesce(F.try_divide(budget - F.try_mod(budget, F.col("source_size")), F.col("source_size")), F.lit(0)).cast("long")
    plan = stored(targets.withColumns({"whole": whole, "left": budget - whole * F.col("source_size")}), "plan")
    cuts, depth = _cuts(sizes, plan.where("left > 0"))
    plan = stored(plan.drop("left").join(cuts, "tree", "left"), "plan")
    own = F.struct(*_digits(depth))
    cut = F.struct("at_key", "at_tie")
    more = F.when(own < cut, F.col("size")).when(own == cut, F.least("left", "size")).otherwise(0)
    taken = F.col("whole") * F.col("size") + F.when(F.col("left").isNull(), 0).otherwise(more)
    return _with(sizes, plan).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "weight")
