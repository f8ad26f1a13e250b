"""Preference formatting: common turn prefix, one prompt, two masked completions.

``format_pairs`` takes one row per pair with ``chosen`` and ``rejected`` as
arrays of struct(role, text). The longest common turn prefix is rendered once
as the prompt; what remains of each side is its completion, with the spans (in
characters of the completion) of what assistants say as its loss mask.

Defined results: turns are ordered by turn number, nulls first, then role and
text; a null role or text renders as empty and equals only another null; equal
conversations give two empty completions; a pair without common turns has an
empty prompt; an empty table gives an empty result. A conversation becomes one
row, so one conversation has to fit in memory; no group of conversations does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: How a turn is rendered: before the role, after it, after the text.
OPEN, MID, CLOSE = "<|turn|>", "\n", "<|end|>\n"


def _head(t: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("")), F.lit(MID))


def _render(t: Column) -> Column:
    return F.concat(_head(t), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE))


def _mask(turns: Column, trained_role: str) -> Column:
    """'start-end,...' of what the trained role says, in characters of the completion."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(F.coalesce(t["text"], F.lit("")))
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        spans = F.when(t["role"] == trained_role, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + F.length(_render(t))).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def format_pairs(pairs: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Adds n_common, prompt, chosen_completion, chosen_mask, rejected_completion, rejected_mask; drops the arrays."""
    shared = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", F.lit(1), shared), F.slice("rejected", F.lit(1), shared), lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(same, F.lit(False)).cast("int")
    out = pairs.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(shared))
    after = F.col("n_common") + 1
    for side in ("chosen", "rejected"):
        out = out.withColumn(f"__{side}", F.slice(side, after, F.size(side)))
    out = out.withColumn("prompt", F.array_join(F.transform(F.slice("chosen", F.lit(1), F.col("n_common")), _render), ""))
    for side in ("chosen", "rejected"):
        out = out.withColumn(f"{side}_completion", F.array_join(F.transform(f"__{side}", _render), ""))
        out = out.withColumn(f"{side}_mask", _mask(F.col(f"__{side}"), trained_role))
    return out.drop("chosen", "rejected", "__chosen", "__rejected")


def gather(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns as ordered array of struct(role, text), said (characters of assistants)."""
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    said = F.coalesce(F.sum(F.when(F.col("role") == "assistant", F.length("text"))), F.lit(0))
    per = turns.groupBy("conv_id").agg(rows.alias("rows"), said.alias("said"))
    return per.select("conv_id", F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"), "said")


def preference_pairs(turns: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen_conv, rejected_conv, chosen, rejected) from a table of turns.

    Conversations with the same opening turn are answers to the same request:
    each is paired with the group's first by id (the first with the last), never
    with all others; the one in which assistants say more is chosen, by id in a
    tie. A conversation that is alone with its opening turn is chosen over its
    own copy whose last assistant turn stops after half its characters (none
    without an assistant turn). Rows with a null conv_id are left out.
    """
    convs = materialize(gather(turns.where(F.col("conv_id").isNotNull())), "convs")
    opening = F.sha2(F.to_json(F.element_at("turns", 1)), 256)
    keyed = convs.select("conv_id", opening.alias("opening"))
    groups = keyed.groupBy("opening").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last")).where("first < last")
    groups = materialize(groups, "openings")
    linked = keyed.join(groups, "opening", "left")
    linked = linked.select("conv_id", F.when(F.col("conv_id") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("other"))
    whole = convs.join(linked, "conv_id").select("conv_id", "turns", "said", "other")
    others = convs.select(F.col("conv_id").alias("other"), F.col("turns").alias("other_turns"), F.col("said").alias("other_said"))
    both = whole.where("other is not null").join(others, "other")
    wins = (F.col("said") > F.col("other_said")) | ((F.col("said") == F.col("other_said")) & (F.col("conv_id") < F.col("other")))
    natural = both.select(
        F.col("conv_id").alias("pair_id"),
        F.when(wins, F.col("conv_id")).otherwise(F.col("other")).alias("chosen_conv"),
        F.when(wins, F.col("other")).otherwise(F.col("conv_id")).alias("rejected_conv"),
        F.when(wins, F.col("turns")).otherwise(F.col("other_turns")).alias("chosen"),
        F.when(wins, F.col("other_turns")).otherwise(F.col("turns")).alias("rejected"),
    )
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: F.coalesce(t["role"] == "assistant", F.lit(False))), F.lit(True)).cast("int")
    half = F.transform(
        "turns",
        lambda t, i: F.when(
            i == F.col("at"), F.struct(t["role"].alias("role"), F.expr("substring(turns[at].text, 1, int(length(turns[at].text) div 2))").alias("text"))
        ).otherwise(t),
    )
    alone = whole.where("other is null").where(F.exists("turns", lambda t: t["role"] == "assistant")).withColumn("at", last)
    own = alone.select(
        F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_conv"), F.col("conv_id").alias("rejected_conv"), F.col("turns").alias("chosen"), half.alias("rejected")
    )
    return natural.unionByName(own)


def op10_preferences(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return format_pairs(preference_pairs(turns))


def _sql_mask(side: str) -> str:
    body = f"{side}[n_common + 1:]"
    return f"""coalesce(array_to_string(list_filter(list_transform(generate_series(1, len({body})), lambda i: case when ({body})[i].role = 'assistant' then
      (coalesce(list_sum(list_transform(({body})[:i - 1], lambda t: length({_sql_turn('t')}))), 0) + length('{OPEN}assistant') + 1)::bigint::varchar || '-' ||
      (coalesce(list_sum(list_transform(({body})[:i - 1], lambda t: length({_sql_turn('t')}))), 0) + length('{OPEN}assistant') + 1 + length(coalesce(({body})[i].text, '')))::bigint::varchar
      end), lambda x: x is not null), ','), '')"""


def _sql_turn(t: str) -> str:
    return f"'{OPEN}' || coalesce({t}.role, '') || chr(10) || coalesce({t}.text, '') || '{CLOSE.strip()}' || chr(10)"


def _sql_join(expr: str) -> str:
    return f"coalesce(array_to_string(list_transform({expr}, lambda t: {_sql_turn('t')}), ''), '')"


SQL = f"""
with c as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role nulls first, text nulls first) as turns,
    coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as said
  from conversations where conv_id is not null group by conv_id
), g as (
  select *, min(conv_id) over (partition by turns[1]) as first, max(conv_id) over (partition by turns[1]) as last from c
), n as (
  select a.conv_id as pair_id, a.conv_id as x, b.conv_id as y, a.turns as t, b.turns as u,
    a.said > b.said or (a.said = b.said and a.conv_id < b.conv_id) as wins
  from g a join c b on b.conv_id = case when a.conv_id = a.first then a.last else a.first end where a.first < a.last
), o as (
  select *, list_max(list_filter(generate_series(1, len(turns)), lambda i: turns[i].role = 'assistant')) as cut from g where first = last
), p as (
  select pair_id, case when wins then x else y end as chosen_conv, case when wins then y else x end as rejected_conv,
    case when wins then t else u end as chosen, case when wins then u else t end as rejected from n
  union all
  select conv_id, conv_id, conv_id, turns, list_transform(generate_series(1, len(turns)),
    lambda i: case when i = cut then {{'role': turns[i].role, 'text': substr(turns[i].text, 1, length(turns[i].text) // 2)}} else turns[i] end) from o where cut is not null
), q as (
  select *, coalesce(list_min(list_filter(generate_series(1, least(len(chosen), len(rejected))), lambda i: chosen[i] is distinct from rejected[i])) - 1,
    least(len(chosen), len(rejected))) as n_common from p
)
select pair_id, chosen_conv, rejected_conv, n_common::int as n_common, {_sql_join('chosen[:n_common]')} as prompt,
  {_sql_join('chosen[n_common + 1:]')} as chosen_completion, {_sql_mask('chosen')} as chosen_mask,
  {_sql_join('rejected[n_common + 1:]')} as rejected_completion, {_sql_mask('rejected')} as rejected_mask
from q
"""
