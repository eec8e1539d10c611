"""Preference pairs as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.operators.windows import sequence_numbers

# The markers of the template; any text is allowed between them.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BREAK), turn["text"], F.lit(CLOSE))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column, trained: str) -> Column:
    """``start:end`` of every ``trained`` turn's text and closing marker in the rendering, in characters."""
    # the characters before a turn are those of the turns up to it
    def span(turn: Column, i: Column) -> Column:
        before = F.length(_text(F.slice(turns, F.lit(1), i)))
        start = before + F.length(F.lit(OPEN + BREAK)) + F.length(turn["role"])
        end = start + F.length(turn["text"]) + len(CLOSE)
        return F.when(turn["role"] == trained, F.concat_ws(":", start.cast("string"), end.cast("string")))
    return F.array_join(F.filter(F.transform(turns, span), lambda x: x.isNotNull()), ",")


def turns_of(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation with its ``turns`` (role, text) in order.

    Rows without conversation or turn number are left out. A null role is
    ``user``, a null text empty. Equal rows count once; different rows of one
    turn follow each other by role and text.
    """
    rows = df.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull()).select(
        F.col(conversation).alias("conv_id"), F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def preference_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected", trained: str = "assistant") -> DataFrame:
    """``df`` with each pair of conversations rendered as prompt and completions.

    ``chosen`` and ``rejected`` are arrays of (role, text). The turns that both
    share from the start are the ``prompt``, rendered once. What follows in each
    becomes ``chosen_text`` and ``rejected_text``; ``chosen_mask`` and
    ``rejected_mask`` list the character spans to learn from: the ``trained``
    role's texts and their closing markers. ``n_prompt_turns`` counts the shared
    turns. A pair whose conversations are equal, or of which one is null, states
    no preference and is left out; if one is the start of the other, its
    completion is empty. A null role is ``user``, a null text empty, and a null
    turn is both. An empty table gives an empty one, repeated rows are rendered
    each for itself. Columns that have the name of a new one are refused.
    """
    taken = {"prompt", "n_prompt_turns", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask"} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    def whole(t: Column) -> Column:
        return F.struct(F.coalesce(t["role"], F.lit("user")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))

    df = df.withColumns({"_a": F.transform(chosen, whole), "_b": F.transform(rejected, whole)})
    a, b = F.col("_a"), F.col("_b")
    shorter = F.least(F.size(a), F.size(b))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(F.array().cast("array<int>"))
    differs = F.filter(places, lambda i: F.element_at(a, i) != F.element_at(b, i))
    shared = F.coalesce(F.array_min(differs) - 1, shorter)
    rest = lambda turns: F.slice(turns, F.col("n_prompt_turns") + 1, F.size(turns))
    cut = df.where(a.isNotNull() & b.isNotNull()).where(a != b).withColumn("n_prompt_turns", shared) \
        .withColumns({"_prompt": F.slice(a, F.lit(1), F.col("n_prompt_turns")), "_chosen": rest(a), "_rejected": rest(b)})
    return cut.withColumns({
        "prompt": _text(F.col("_prompt")), "chosen_text": _text(F.col("_chosen")), "chosen_mask": _spans(F.col("_chosen"), trained),
        "rejected_text": _text(F.col("_rejected")), "rejected_mask": _spans(F.col("_rejected"), trained),
    }).drop("_prompt", "_chosen", "_rejected", "_a", "_b")


def swapped_replies(df: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: a conversation up to its last reply, and the same with the last
    reply of its neighbour (conversation ids 2n and 2n + 1 are neighbours). Both need a reply."""
    talks = turns_of(df).withColumn("_last", F.array_max(F.transform(
        "turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)))).where(F.col("_last").isNotNull())
    talks = talks.select("conv_id", F.slice("turns", F.lit(1), F.col("_last")).alias("chosen"))
    replies = talks.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.element_at("chosen", -1).alias("_reply"))
    pairs = talks.join(replies, "conv_id").withColumn("rejected", F.concat(
        F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array("_reply")))
    return preference_pairs(pairs).select(
        "conv_id", "n_prompt_turns", "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")


def _replies(turns: Column) -> Column:
    """The places of the replies, from 1."""
    return F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda x: x.isNotNull())


def branched_replies(df: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations, of every conversation with a reply and the next one that has a reply
    (in the order of ids, after the last the first).

    Chosen is the conversation up to its last reply. Rejected leaves it at one of its replies, picked by a hash of the
    id, and goes on as the next one does from its reply of that number (its last if it has fewer) to its last reply.
    Equal conversations state no preference.
    """
    ids = df.where((F.col("role") == "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id").distinct()
    rows, shifts = sequence_numbers(ids, ["conv_id"])
    # one row per slab: windows.SLABS bounds its size
    numbered = rows.join(F.broadcast(shifts), "_slab").select("conv_id", (F.col("_row") + F.col("_shift")).alias("_number"), "_total")
    following = numbered.select(F.col("conv_id").alias("_next"), F.pmod(F.col("_number") - 1, F.col("_total")).alias("_number"))
    nexts = numbered.join(following, "_number").select("conv_id", "_next")
    talks = turns_of(df).withColumn("_replies", _replies(F.col("turns"))).where(F.size("_replies") > 0).select(
        "conv_id", F.slice("turns", F.lit(1), F.element_at("_replies", -1)).alias("chosen"), "_replies")
    others = talks.select(F.col("conv_id").alias("_next"), F.col("chosen").alias("_other"), F.col("_replies").alias("_others"))
    which = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.size("_replies")).cast("int")
    pairs = talks.join(nexts, "conv_id").join(others, "_next").withColumn("_which", which + 1).withColumn("rejected", F.concat(
        F.slice("chosen", F.lit(1), F.element_at("_replies", F.col("_which")) - 1),
        F.slice("_other", F.element_at("_others", F.least("_which", F.size("_others"))), F.size("_other"))))
    return preference_pairs(pairs).select(
        "conv_id", "n_prompt_turns", "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")


SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
  '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown FROM t),
l AS (SELECT conv_id, max(i) AS last FROM n WHERE role = 'assistant' GROUP BY conv_id),
r AS (SELECT conv_id, last, text, shown FROM n JOIN l USING (conv_id) WHERE i = last),
p AS (SELECT c.conv_id, c.last, c.text AS chosen, x.text AS rejected, c.shown AS chosen_shown, x.shown AS rejected_shown
  FROM r c JOIN r x ON x.conv_id = xor(c.conv_id, 1) WHERE c.text <> x.text)
SELECT conv_id, CAST(last - 1 AS INTEGER) AS n_prompt_turns,
  coalesce((SELECT string_agg(n.shown, '' ORDER BY n.i) FROM n WHERE n.conv_id = p.conv_id AND n.i < p.last), '') AS prompt,
  chosen_shown AS chosen_text, '22:' || (22 + length(chosen) + 11) AS chosen_mask,
  rejected_shown AS rejected_text, '22:' || (22 + length(rejected) + 11) AS rejected_mask
FROM p
"""
