"""Mixing sources to target token shares with capped repetition.

Each source owes share x budget tokens, at most max_repeats x its size. Complete
epochs come first: every document is used that many times. The rest is drawn
without replacement by exponential keys -ln(u) / weight (Efraimidis-Spirakis):
documents in the order of their keys, until the running sum of tokens would pass
what is left. No source is ever sorted in one task: keys fall into buckets by a
monotone map, sums of buckets (source x bucket, a bounded table) locate the one
bucket where the budget ends, and only that bucket is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.bpe import DEFAULT_VOCABULARY, count_tokens
from sievework.session import BROADCAST_ROWS, bounded, cut

#: Buckets of keys in a source: the boundary bucket holds about 1/BUCKETS of its documents.
BUCKETS = 8192


def quality_weight(text: Column) -> Column:
    """A document's weight in the fractional draw, 0.5 to 1.5: half plus its share of letters."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.lit(0.5) + F.coalesce(F.try_divide(letters.cast("double"), F.length(text).cast("double")), F.lit(0.0))


def sizes(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, weight_col: str | None = None) -> DataFrame:
    """doc_id, source, weight, tokens of each document, written to the shared folder once.

    ``weight_col`` names a column of quality weights; a null or one that is not positive is drawn last.
    """
    weight = quality_weight(F.col("text")) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    slim = documents.select(F.col("doc_id"), F.col("source"), weight.alias("weight"), F.col("text"))
    return cut(count_tokens(slim, "text", "tokens", vocabulary))


def draw_key(id_col: str, weight_col: str, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the id: the same on every run."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return -F.log(u) / F.greatest(F.col(weight_col), F.lit(1e-9))


def plan(sized: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """A row per target: documents and tokens there are, tokens owed, complete epochs, tokens left to draw.

    ``budget`` is the size of the mixture in tokens; unset, the tokens of all listed
    sources. Documents of null source and of sources not listed stay out; a listed
    source without documents owes its share but can give nothing.
    """
    have = sized.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))
    wanted = targets.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = wanted.join(have, "source", "left").select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"), F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    whole = F.sum("tokens").over(Window.partitionBy()) if budget is None else F.lit(int(budget))
    owed = both.withColumn("owed", F.floor(F.col("target_share") * whole).cast("bigint"))
    amount = F.least("owed", F.col("tokens") * F.col("max_repeats"))
    epochs = F.coalesce(F.floor(F.try_divide(amount.cast("double"), F.col("tokens").cast("double"))), F.lit(0)).cast("int")
    return owed.withColumn("epochs", epochs).withColumn("rest", amount - F.col("epochs") * F.col("tokens"))


def select(sized: DataFrame, plans: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, tokens, uses: how often each document enters the mixture (never 0).

    Ties of keys are broken by id; a document whose tokens would pass the budget ends
    the draw; documents without tokens are drawn as their keys come.
    """
    listed = sized.where("source is not null").join(bounded(plans.select("source", "epochs", "rest", "max_repeats")), "source")
    keyed = listed.withColumn("key", draw_key("doc_id", "weight", seed)).withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS).cast("int"))
    sums = keyed.where("rest > 0").groupBy("source", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("source", "bucket", F.coalesce(F.sum("bucket_tokens").over(so_far), F.lit(0)).alias("before"), "bucket_tokens")
    # at most BUCKETS rows a source, whatever the corpus; broadcast while that is small
    placed = keyed.join(F.broadcast(before) if plans.count() * BUCKETS <= BROADCAST_ROWS else before.hint("merge"), ["source", "bucket"], "left")
    whole = placed.where("before + bucket_tokens <= rest")
    edge = placed.where("rest > 0 and before <= rest and before + bucket_tokens > rest")
    running = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    partly = edge.withColumn("upto", F.col("before") + F.sum("tokens").over(running)).where("upto <= rest")
    drawn = whole.select("doc_id", "source", "tokens", "epochs").unionByName(partly.select("doc_id", "source", "tokens", "epochs"))
    once = drawn.withColumn("uses", F.lit(1)).unionByName(listed.where("epochs > 0").select("doc_id", "source", "tokens", "epochs").withColumn("uses", F.col("epochs")))
    return once.groupBy("doc_id", "source").agg(F.max("tokens").alias("tokens"), F.sum("uses").cast("int").alias("uses"))


def report(plans: DataFrame, chosen: DataFrame) -> DataFrame:
    """A row per target: what was asked, what there is, what was taken, the share reached."""
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("mixed_tokens"), F.count(F.lit(1)).alias("mixed_docs"), F.max("uses").alias("most_uses"))
    full = plans.join(got, "source", "left").na.fill(0, ["mixed_tokens", "mixed_docs", "most_uses"])
    total = F.sum("mixed_tokens").over(Window.partitionBy())
    return full.select(
        "source", "target_share", "max_repeats", "docs", "tokens", "owed", "epochs", "mixed_docs", "mixed_tokens", "most_uses",
        F.coalesce(F.try_divide(F.col("mixed_tokens").cast("double"), total.cast("double")), F.lit(0.0)).alias("actual_share"),
    )


def mix(documents: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 17, vocabulary: str = DEFAULT_VOCABULARY, weight_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(selection, report), drawn by the weights of ``weight_col`` or by a stand-in for quality. Empty documents or targets give empty results; doc_id must be unique."""
    sized = sizes(documents, vocabulary, weight_col)
    plans = cut(plan(sized, targets, budget))
    chosen = select(sized, plans, seed)
    return chosen, report(plans, chosen)
