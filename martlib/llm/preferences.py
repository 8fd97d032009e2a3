"""Preference pairs: a shared prompt, and chosen and rejected completions with loss masks.

The longest common turn prefix of the two conversations of a pair is rendered
once as the prompt. What follows on either side is rendered as its completion. A
mask lists the spans of a completion that a model is trained on: the texts of
assistant turns and the mark that ends them. Everything else, the prompt
included, is masked.

All of it is grouping and SQL functions. The first turn that differs is an
aggregate over (pair, turn), so no conversation is compared as a whole; only the
rendered texts, which are the result, are put together per pair.

Cases: turns are ordered by number, then role and text, nulls first; rows that
repeat are turns of their own. A null role or text is rendered as empty, and
equals only null. A pair with one side has an empty prompt, and the missing side
an empty completion. Rows with a null conversation id belong to no pair. If one
conversation is the beginning of the other, all of it is the prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.registry import query, table

OPEN, BREAK, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"

SQL = """
with numbered as (
  select conv_id // 2 as pair_id, conv_id % 2 = 0 as is_chosen, role, text,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
  from conversations where conv_id is not null
),
turns as (
  select pair_id, place, count(*) as sides,
    max(case when is_chosen then 1 else 0 end) as has_chosen, max(case when not is_chosen then 1 else 0 end) as has_rejected,
    max(case when is_chosen then role end) as c_role, max(case when is_chosen then text end) as c_text,
    max(case when not is_chosen then role end) as r_role, max(case when not is_chosen then text end) as r_text
  from numbered group by pair_id, place
),
marked as (
  select *, sum(case when sides = 2 and c_role is not distinct from r_role and c_text is not distinct from r_text then 0 else 1 end) over (partition by pair_id order by place) = 0 as shared,
    '<|' || coalesce(c_role, '') || '|>' || chr(10) as c_head, coalesce(c_text, '') as c_body,
    '<|' || coalesce(r_role, '') || '|>' || chr(10) as r_head, coalesce(r_text, '') as r_body
  from turns
),
placed as (
  select *,
    case when has_chosen = 1 and not shared then length(c_head) + length(c_body) + 8 else 0 end as c_size,
    case when has_rejected = 1 and not shared then length(r_head) + length(r_body) + 8 else 0 end as r_size
  from marked
),
spanned as (
  select *, sum(c_size) over w - c_size as c_at, sum(r_size) over w - r_size as r_at from placed window w as (partition by pair_id order by place)
)
select pair_id, cast(sum(case when shared then 1 else 0 end) as bigint) as n_shared,
  coalesce(string_agg(case when shared then c_head || c_body || '<|end|>' || chr(10) end, '' order by place), '') as prompt,
  coalesce(string_agg(case when not shared and has_chosen = 1 then c_head || c_body || '<|end|>' || chr(10) end, '' order by place), '') as chosen,
  coalesce(string_agg(case when not shared and has_rejected = 1 then r_head || r_body || '<|end|>' || chr(10) end, '' order by place), '') as rejected,
  coalesce(string_agg(case when not shared and c_role = 'assistant' then (c_at + length(c_head))::bigint || ':' || (c_at + c_size)::bigint end, ',' order by place), '') as chosen_mask,
  coalesce(string_agg(case when not shared and r_role = 'assistant' then (r_at + length(r_head))::bigint || ':' || (r_at + r_size)::bigint end, ',' order by place), '') as rejected_mask
from spanned group by pair_id
"""


def rendered(role: Column, text: Column) -> Column:
    return F.concat(head(role), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(BREAK))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair from ``pair_id, chosen (boolean), conv_id, turn, role, text``.

    Gives ``n_shared`` (turns of the prompt), ``prompt``, ``chosen``, ``rejected`` and the
    trained spans of the completions, ``chosen_mask`` and ``rejected_mask``, as ``start:end`` in code points.
    """
    order = Window.partitionBy("pair_id", "chosen", "conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    numbered = turns.where("pair_id is not null and conv_id is not null").select("pair_id", "chosen", "role", "text", F.row_number().over(order).alias("place"))
    side = lambda is_chosen: F.max(F.when(F.col("chosen") == F.lit(is_chosen), F.struct("role", "text")))
    by_turn = numbered.groupBy("pair_id", "place").agg(side(True).alias("c"), side(False).alias("r"))
    same = F.col("c").isNotNull() & F.col("r").isNotNull() & F.col("c.role").eqNullSafe(F.col("r.role")) & F.col("c.text").eqNullSafe(F.col("r.text"))
    listed = F.array_sort(F.collect_list(F.struct("place", "c", "r")))
    pairs = by_turn.groupBy("pair_id").agg(F.min(F.when(~same, F.col("place"))).alias("first"), F.count(F.lit(1)).alias("n"), listed.alias("turns"))
    pairs = pairs.withColumn("n_shared", (F.coalesce(F.col("first"), F.col("n") + 1) - 1).cast("long"))

    def text_of(rows, name):
        return F.array_join(F.transform(rows, lambda x: rendered(x[name]["role"], x[name]["text"])), "")

    def spans_of(rows, name):
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc, x):
            begin = acc["at"] + F.length(head(x[name]["role"]))
            end = acc["at"] + F.length(rendered(x[name]["role"], x[name]["text"]))
            span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
            return F.struct(end.cast("long").alias("at"), F.when(x[name]["role"] == TRAINED, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.array_join(F.aggregate(rows, start, step, lambda acc: acc["out"]), ",")

    prompt = F.filter("turns", lambda x: x["place"] <= F.col("n_shared"))
    chosen = F.filter("turns", lambda x: (x["place"] > F.col("n_shared")) & x["c"].isNotNull())
    rejected = F.filter("turns", lambda x: (x["place"] > F.col("n_shared")) & x["r"].isNotNull())
    return pairs.select(
        "pair_id", "n_shared", text_of(prompt, "c").alias("prompt"), text_of(chosen, "c").alias("chosen"), text_of(rejected, "r").alias("rejected"),
        spans_of(chosen, "c").alias("chosen_mask"), spans_of(rejected, "r").alias("rejected_mask"),
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Conversations 2k and 2k + 1 as the chosen and the rejected one of pair k."""
    c = F.col("conv_id")
    return conversations.select(F.floor(c / 2).cast("long").alias("pair_id"), (F.pmod(c, F.lit(2)) == 0).alias("chosen"), "conv_id", "turn", "role", "text")


@query("op3_preferences", SQL)
def op3_preferences(spark, folder):
    return preference_pairs(neighbours(table(spark, folder, "conversations")))
