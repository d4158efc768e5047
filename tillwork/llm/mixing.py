"""Mix sources to target weights by weighted fair queueing.

Every source plays its documents in a shuffled order, again from the start when it needs more
than it has. A copy's virtual finish time is the source's tokens up to and with it, divided by
the source's target; all copies are range-sorted by that time and cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, running_total, saved

WEIGHTS = (3, 1, 2)  # the sources in order of their names take these in turn
SHARE = 1.5  # of all tokens
EPOCHS = 2  # a source plays at most so often


def word_count(text: Column) -> Column:
    """Number of runs without blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Sources (source, source_size) with weight, target and rank.

    The budget goes by weight; a source is full at epochs times its size and what it cannot take
    goes to the others by weight, until none is above. Sources are ranked by code point, null
    last, with a range sort, so their number is not limited.
    """
    ranked = running_total(sources.withColumn("one", F.lit(1).cast("long")), ["source"], ["one"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    ranked = saved(
        ranked.select("source", "source_size", F.col("before_one").alias("rank"), weight.alias("weight"))
        .withColumn("most", F.col("source_size") * F.lit(float(epochs))), "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # each round fills at least one more source or ends
        is_full = F.col("most") < F.col("weight") * F.lit(level) if full >= 0 else F.lit(False)
        n, taken, open_weight = ranked.agg(
            F.count_if(is_full), F.sum(F.when(is_full, F.col("most"))), F.sum(F.when(~is_full, F.col("weight")))
        ).first()
        if n == full or not open_weight:
            break
        full, level = n, (share * total - (taken or 0.0)) / open_weight
    level = level if open_weight else float("inf")
    return ranked.withColumn("target", F.when(F.col("weight") * F.lit(level) > F.col("most"), F.col("most")).otherwise(F.col("weight") * F.lit(level)))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = "mix",
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (tokens) and copies taken.

    docs: doc_id, text, source, and any other columns, of which `carry` names those to keep. A null text has size
    0, a null source is a source of its own, a null doc_id is shuffled like an empty one. Repeated rows are
    documents of their own. Copies are whole: the budget ends before the first copy that
    would pass it. The order is a digest of doc_id, so reruns agree. Empty in, empty out.
    """
    carry = carry or []
    sized = saved(
        narrow(docs, "doc_id", "source", "text", *carry).select("doc_id", "source", *carry, word_count(F.col("text")).alias("size")), "sizes"
    )
    per_source = targets(saved(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sums"), weights, share, epochs)
    per_source = saved(running_total(per_source, ["rank"], ["source_size"]).drop("pid"), "targets")
    keyed = sized.join(per_source, sized["source"].eqNullSafe(per_source["source"]), "left").select(
        "doc_id", sized["source"], *carry, "size", "source_size", "rank", "target", "before_source_size", shuffle_key(F.col("doc_id"), seed).alias("shuffled")
    )
    queued = running_total(keyed, ["rank", "shuffled", "doc_id", "size"], ["size"])
    done = F.col("before_size") - F.col("before_source_size") + F.col("size")  # the source's tokens with this document
    queued = saved(queued.select("doc_id", "source", *carry, "size", "source_size", "rank", "target", "shuffled", done.alias("done")), "queue")

    def finish(epoch: Column) -> Column:
        return F.when(F.col("size") == 0, F.lit(0.0)).otherwise((F.col("done") + epoch * F.col("source_size")) / F.col("target"))

    # the copies in the global order; all of them before the first that passes the budget are taken
    copies = queued.select("rank", "done", "size", F.explode(F.array(*[F.lit(e) for e in range(epochs)])).alias("epoch"), "source_size", "target")
    copies = copies.filter("size > 0").select(finish(F.col("epoch")).alias("finish"), "rank", "done", "size")
    ordered = running_total(copies, ["finish", "rank", "done"], ["size"])
    budget = share * (sized.agg(F.sum("size")).first()[0] or 0)
    cut = ordered.filter(F.col("before_size") + F.col("size") > F.lit(budget)).agg(F.min(F.struct("finish", "rank", "done"))).first()[0]
    taken = F.lit(0)
    for e in range(epochs):
        now = F.struct(finish(F.lit(e)).alias("finish"), "rank", "done")
        at = F.lit(True) if cut is None else now < F.struct(F.lit(cut[0]).alias("finish"), F.lit(cut[1]).alias("rank"), F.lit(cut[2]).alias("done"))
        taken = taken + at.cast("int")
    return queued.withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(F.lit(1))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", *carry
    )
