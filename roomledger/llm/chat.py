"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; runs of the same role become one block;
blocks are concatenated to the formatted text:

    <|role|>first turn<+>second turn</s><|next role|>...</s>

Texts and roles are escaped so that no mark can occur inside them: ``\\`` becomes ``\\e``, ``<`` becomes
``\\l`` and ``|`` becomes ``\\p``. Every mark contains a ``<``, so a formatted text can be cut at its marks
and unescaped again (``parse``). The loss mask (``loss_spans``) covers the texts of the assistant's turns;
what is under it is cut out of the formatted text by its offsets (``under_mask``).

A conversation's turns are first put together per range of turn numbers and then per conversation,
so the tasks that sort are small even where one conversation has very many rows. Its formatted text
is one value, as asked for, and so must fit into one row (2 GB).

Defined results: null text and null role are empty; a null conv_id or turn is a value of its own that
sorts first; repeated rows are turns of their own, ordered by role and text; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import digest, settled

LOSS_ROLE = "assistant"
TURNS_PER_RANGE = 256
PART = 64  # blocks that are summed and cut together
OPEN, CLOSE, JOIN, END = "<|", "|>", "<+>", "</s>"
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("|", "\\p"))  # the escape character's own comes first


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def merge_adjacent(df: DataFrame, blocks: str) -> DataFrame:
    """``blocks`` with adjacent blocks of one role made one, their bodies joined; linear in the number of blocks."""
    df = settled(df)
    places = F.sequence(F.lit(0), F.size(blocks) - 1)
    df = settled(df.withColumn("starts", F.filter(places, lambda i: (i == 0) | (F.get(blocks, i)["role"] != F.get(blocks, i - 1)["role"]))))

    def merged(start: Column, number: Column) -> Column:
        stop = F.coalesce(F.get("starts", number + 1), F.size(blocks))
        bodies = F.transform(F.slice(blocks, start + 1, stop - start), lambda b: b["body"])
        return F.struct(F.get(blocks, start)["role"].alias("role"), F.array_join(bodies, JOIN).alias("body"))

    return settled(df.withColumn(blocks, F.transform("starts", merged)).drop("starts"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start and end of each masked turn, in code points)."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        escape(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col("text"), F.lit(""))).alias("body"),
    )
    span = F.floor(F.col("turn") / TURNS_PER_RANGE).alias("span")
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "body")))
    ranges = rows.groupBy("conv_id", span).agg(sorted_turns.alias("turns"))
    ranges = ranges.select("conv_id", "span", F.transform("turns", lambda t: F.struct(t["role"], t["body"])).alias("blocks"))
    ranges = merge_adjacent(ranges, "blocks")
    whole = ranges.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("span", "blocks"))).alias("spans"))
    whole = whole.select("conv_id", F.flatten(F.transform("spans", lambda s: s["blocks"])).alias("blocks"))
    blocks = merge_adjacent(whole, "blocks")
    written = F.transform("blocks", lambda b: F.concat(F.lit(OPEN), b["role"], F.lit(CLOSE), b["body"], F.lit(END)))
    found = settled(settled(blocks.withColumn("parts", parts_of(F.col("blocks")))).withColumn("found", F.transform("parts", loss_spans)))
    found = settled(found.withColumn("starts", starts_of(F.transform("found", lambda f: f["at"]))))

    def shifted(found: Column, start: Column) -> Column:
        return F.transform(found["spans"], lambda s: F.struct((s["start"] + start).alias("start"), (s["end"] + start).alias("end")))

    spans = F.flatten(F.zip_with("found", "starts", shifted))
    return found.select("conv_id", F.array_join(written, "").alias("formatted"), spans.alias("loss_spans"))


def parts_of(values: Column) -> Column:
    """An array (not empty) cut into arrays of ``PART`` elements: sums and cuts along a conversation go part by part."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / PART).cast("int"))
    return F.transform(numbers, lambda n: F.slice(values, n * PART + 1, F.lit(PART)))


def starts_of(sizes: Column) -> Column:
    """The sum of the sizes before each one."""
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))

    def step(state: Column, size: Column) -> Column:
        return F.struct((state["at"] + size).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    return F.aggregate(sizes, first, step, lambda s: s["starts"])


def loss_spans(blocks: Column) -> Column:
    """The length of some blocks as written (``at``), and where the turns of the loss role stand in them (``spans``)."""
    bodies = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(b["body"], "<\\+>", -1),
                lambda text, i: F.struct(
                    b["role"].alias("role"),
                    F.length(text).alias("size"),
                    F.when(i == 0, F.length(b["role"]) + len(OPEN + CLOSE)).otherwise(len(JOIN)).alias("before"),
                    F.when(i == F.size(F.split(b["body"], "<\\+>", -1)) - 1, len(END)).otherwise(0).alias("after"),
                ),
            ),
        )
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + turn["before"]
        end = start + turn["size"]
        here = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == LOSS_ROLE, F.concat(state["spans"], here)).otherwise(state["spans"])
        return F.struct((end + turn["after"]).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    return F.aggregate(bodies, first, step)


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped, in order."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, CLOSE, 1)  # with the opening mark
        body = F.substring(block, F.length(role) + len(CLOSE) + 1, F.length(block))
        return F.transform(
            F.split(body, "<\\+>", -1),
            lambda text: F.struct(
                unescape(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"), unescape(text).alias("text")
            ),
        )

    return F.flatten(F.transform(blocks, turns))


def under_mask(formatted: DataFrame) -> DataFrame:
    """``masked``: the text under the loss mask, cut out of the formatted text by the mask's offsets and unescaped.

    Cutting by an offset goes through the text from its beginning, so the text is taken in parts of ``PART`` blocks
    first; a span lies within one block.
    """
    blocks = F.transform(F.filter(F.split("formatted", END, -1), lambda b: b != ""), lambda b: F.concat(b, F.lit(END)))
    cut = settled(settled(formatted).withColumn("blocks", blocks))
    cut = settled(cut.withColumn("texts", F.transform(parts_of(F.col("blocks")), lambda p: F.array_join(p, ""))))
    cut = settled(cut.withColumn("starts", starts_of(F.transform("texts", lambda t: F.length(t).cast("bigint")))))

    def masked(text: Column, start: Column) -> Column:
        own = F.filter("loss_spans", lambda s: (s["start"] >= start) & (s["end"] <= start + F.length(text)))
        pieces = F.transform(own, lambda s: F.substring(text, (s["start"] - start + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
        return F.array_join(F.transform(pieces, unescape), "")

    return cut.withColumn("masked", F.array_join(F.zip_with("texts", "starts", masked), "")).drop("blocks", "texts", "starts")


def read_back(formatted: DataFrame) -> DataFrame:
    """Figures of each conversation: its turns from its formatted text alone, the loss from the mask's offsets in it."""
    parsed = under_mask(formatted).select("conv_id", "formatted", "masked", parse(F.col("formatted")).alias("turns"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.col("masked")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(lines, "")).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        digest(masked).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
