"""Training slices and examples: quotas, sampling, mixes, chat forms, checks and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galenus.functions.text import token_count

ABSTAIN_REASONS = ("no_data", "out_of_scope", "ambiguous_entity", "needs_company_data")


def licence_gate(kind: Column, source: Column, subset: Column, lookup_subsets: Column, excluded: tuple[str, ...]) -> Column:
    """Why a row may not be used; null if it may. Tool rows need every lookup source to be commercial."""
    lookups = F.coalesce(lookup_subsets, F.array().cast("array<string>"))
    return (
        F.when(source.isin(*excluded) if excluded else F.lit(False), "excluded_source")
        .when((kind == "tool_draft") & F.exists(lookups, lambda s: s.isNull()), "pending_licence")
        .when((kind == "tool_draft") & F.exists(lookups, lambda s: s != "commercial"), "non_commercial")
        .when((kind != "tool_draft") & subset.isNull(), "pending_licence")
        .when((kind != "tool_draft") & (subset != "commercial"), "non_commercial")
    )


def keep_share(rows: DataFrame, target_tokens: int, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, tokens, share): min(1, target x weight / all weights / available tokens); without weights, by available tokens."""
    have = rows.groupBy("source").agg(F.sum(token_count(F.col("text"))).cast("double").alias("tokens"))
    if weights:
        table = F.create_map(*(x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))))
        have = have.withColumn("w", F.try_element_at(table, F.col("source"))).filter("w > 0")
    else:
        have = have.withColumn("w", F.col("tokens"))
    total = have.agg(F.sum("w").alias("total_w"))
    share = F.least(F.lit(1.0), F.lit(float(target_tokens)) * F.col("w") / F.col("total_w") / F.nullif(F.col("tokens"), F.lit(0.0)))
    return have.crossJoin(F.broadcast(total)).select("source", "tokens", F.coalesce(share, F.lit(0.0)).alias("share"))  # one row


def build_slice(rows: DataFrame, target_tokens: int, weights: dict[str, float] | None = None, excluded: tuple[str, ...] = (), seed: int = 0, order: str = "id") -> tuple[DataFrame, DataFrame]:
    """(sampled rows, outcome counts). Commercial rows are kept by a hash of content and seed, then repeats of a content hash go.

    The hash makes the sample the same under any partitioning.
    """
    usable = rows.filter(~F.col("source").isin(*excluded)) if excluded else rows
    shares = keep_share(usable.filter("subset = 'commercial'"), target_tokens, weights)
    hash_ = F.coalesce("content_hash", F.sha2("text", 256))
    marked = rows.withColumn("_hash", hash_).join(F.broadcast(shares.select("source", "share")), "source", "left")  # a row per source
    draw = F.conv(F.substring(F.sha2(F.concat("_hash", F.lit(str(seed))), 256), 1, 8), 16, 10).cast("double") / (1 << 32)
    state = (
        F.when(F.col("source").isin(*excluded) if excluded else F.lit(False), "refused_excluded")
        .when(~F.coalesce(F.col("subset") == "commercial", F.lit(False)), "non_commercial")
        .when(F.col("share").isNull(), "skipped_no_weight")
        .when(F.col("_hash").isNull() | (draw >= F.col("share")), "not_sampled")
        .otherwise("sampled")
    )
    marked = marked.withColumn("outcome", state)
    w = Window.partitionBy("_hash").orderBy(order)
    kept = marked.filter("outcome = 'sampled'").withColumn("_rank", F.row_number().over(w))
    counts = marked.filter("outcome <> 'sampled'").groupBy("outcome").count()
    counts = counts.unionByName(kept.groupBy(F.when(F.col("_rank") == 1, "kept").otherwise("duplicate").alias("outcome")).count())
    return kept.filter("_rank = 1").drop("_rank", "_hash", "share", "outcome"), counts


def interleave(main: DataFrame, other: DataFrame, ratio: float, order: str) -> DataFrame:
    """Rows of both at a target share of ``main``: position n of a stream stands at n / share of its stream.

    Positions come from a two-step count over range partitions, not one sort.
    """
    from galenus.operators.sampling import with_position

    place = lambda df, share, tag: with_position(df, order).withColumn("place", (F.col("position") - 0.5) / share).withColumn("stream", F.lit(tag))
    return place(main, ratio, 0).unionByName(place(other, 1 - ratio, 1), allowMissingColumns=True)


def chat_grounded(question: Column, passage: Column, ref: Column, answer: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("user", F.concat(F.lit("Passage ["), ref, F.lit("]:\n"), passage, F.lit("\n\nQuestion: "), question)), turn("assistant", answer))


def chat_abstain(question: Column, reason: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("user", question), turn("assistant", F.when(reason.isin(*ABSTAIN_REASONS), reason).otherwise(F.raise_error(F.lit("unknown reason")))))


def chat_tool(task: Column, calls: Column, results: Column, answer: Column) -> Column:
    """``calls`` array<struct<name, arguments>>, ``results`` array<string>: one assistant turn with all calls, a tool turn per result, the answer."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    asked = F.when(F.size(calls) > 0, F.array(turn("assistant", F.to_json(calls)))).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(F.array(turn("user", task)), asked, F.transform(results, lambda r: turn("tool", r)), F.array(turn("assistant", answer)))


def chat_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat): ordered turns of each conversation as JSON."""
    items = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(items.alias("t")).select("conv_id", F.size("t").alias("n_turns"), F.to_json(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))).alias("chat"))


def preference_pairs(rows: DataFrame) -> DataFrame:
    """(prompt, chosen, rejected) of rows with both answers that differ."""
    return rows.filter("prompt is not null and chosen is not null and rejected is not null and chosen <> rejected").select("prompt", "chosen", "rejected")


def accuracy(rows: DataFrame, predicted: str = "predicted", gold: str = "gold") -> DataFrame:
    ok = F.coalesce(F.col(predicted) == F.col(gold), F.lit(False))
    return rows.agg(F.count("*").alias("total"), F.count_if(ok).alias("correct"), F.round(100.0 * F.count_if(ok) / F.nullif(F.count("*"), F.lit(0)), 4).alias("accuracy_pct"))


def draft_score(expected: DataFrame, drafts: DataFrame) -> DataFrame:
    """Per case: share of expected facts that the draft contains, and of expected gaps that it reports. ``expected``: case_id, kind, value."""
    j = expected.join(drafts, "case_id", "left")
    hit = F.coalesce(F.contains(F.lower("draft"), F.lower("value")), F.lit(False)).cast("double")
    return j.groupBy("case_id").agg(F.avg(F.when(F.col("kind") == "fact", hit)).alias("facts_found"), F.avg(F.when(F.col("kind") == "gap", hit)).alias("gaps_reported"))


def truncate_tokens(text: Column, most: int = 512) -> Column:
    """The first ``most`` white-space tokens."""
    return F.array_join(F.slice(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S+"), F.lit(0)), 1, most), " ")
