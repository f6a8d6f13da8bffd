"""Chat formatting in budgeted windows, with DataFrame expressions only.

A conversation becomes windows of whole turns. Running sums of the turns' token estimates choose where a window
ends: a turn that would lift the window above the budget opens the next one, so each turn is new in exactly one window. All
windows but the first begin with the conversation's system turn, if it has one, and the latest earlier turns whose tokens
fit the history allowance; both count towards the budget. The loss mask covers the texts of new assistant turns; repeated turns
are masked.

Long conversations are worked on in stretches of STRETCH turn numbers, each with the turns that may be repeated in it, so that no
task holds more of a conversation; a stretch opens a window.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` for each turn. In texts ``\\`` is doubled and a ``\\`` is put after the
first character of every control string; in roles ``%``, line feed and ``<`` are percent-encoded. Both undo exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.common import small_side, written

# The template's marks, and the control strings of common chat templates.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CONTROL_TAILS = ["<SYS>>", "</SYS>>", r"\|im_start\|>", r"\|im_end\|>", r"\|endoftext\|>", "/?s>", r"/?INST\]"]

BUDGET, HISTORY, STRETCH = 1024, 128, 256


def escape(text: Column) -> Column:
    """Break up control strings reversibly."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={'|'.join(CONTROL_TAILS)})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    for a, b in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def unescape_role(role: Column) -> Column:
    for a, b in (("%3C", "<"), ("%0A", "\n"), ("%25", "%")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def tokens(text: Column) -> Column:
    """Token estimate of a turn: a quarter of its characters, rounded up, and four for the marks."""
    return F.ceil(F.length(text) / 4).cast("long") + F.lit(4)


def with_places(conversations: DataFrame, stretch: int, crowd: int) -> DataFrame:
    """conv_id, alone, at, turn, role, text: at is the turn's place, its turn number unless many turns share numbers.

    alone tells rows without conv_id apart. Turns are counted only in conversations that have more than crowd rows in a stretch.
    """
    turn, role, text = F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long")).alias("alone")
    rows = conversations.select("conv_id", alone, turn, role, text).withColumn("at", F.coalesce("turn", F.lit(-(2**63))))
    crowded = rows.where("conv_id is not null").groupBy("conv_id", F.floor(F.col("at") / stretch).alias("s")).agg(F.count("*").alias("n"))
    crowded = written(crowded.where(F.col("n") > crowd).select("conv_id").distinct(), "crowded")
    if not crowded.take(1):
        return rows
    side = small_side(crowded)
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    counted = rows.join(side, "conv_id", "left_semi").withColumn("at", F.row_number().over(w).cast("long") - 1)
    calm = rows.join(side, "conv_id", "left_anti")
    return calm.select(rows.columns).unionByName(counted.select(rows.columns))


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, stretch: int = STRETCH, crowd: int = 4096, whole: bool = False) -> DataFrame:
    """One row for each window: conv_id, alone, stretch, window, text, n_repeated, loss (array of struct(start, length)).

    Takes rows (conv_id, turn, role, text); other columns are left out and an empty table gives no window. A null text or role is
    empty; rows of one turn number are ordered by role and text, a null turn comes first, repeated rows are turns of their
    own, and each row without conv_id is a conversation of its own, which alone numbers. A turn that does not fit the budget
    beside the system turn and the history has a window for itself; texts are never cut. start and length count
    characters (code points). A conversation's windows follow each other by stretch and window. whole: rows are dealt by
    conversation, for a caller who needs each in one row anyway and so saves a second shuffle.
    """
    rows = with_places(conversations, stretch, crowd)
    if whole:
        rows = rows.repartition("conv_id", "alone")
    reach = min(stretch, history // 4 + 1)  # as many turns as the history can hold
    number = lambda at: F.floor(at / stretch) if stretch & (stretch - 1) else F.shiftright(at, stretch.bit_length() - 1)
    own = rows.withColumn("stretch", number(F.col("at")))
    places = [F.struct((F.col("stretch") + k).alias("stretch"), F.lit(2 - k).alias("kind")) for k in (0, 1)]
    late = F.pmod("at", F.lit(stretch)) >= stretch - reach
    every = rows.withColumn("stretch", number(F.col("at"))).select("*", F.explode(F.when(late, F.array(*places)).otherwise(F.array(places[0]))).alias("p"))
    every = every.select("conv_id", "alone", "at", "turn", "role", "text", "p.*")
    extents = own.groupBy("conv_id", "alone").agg(F.min("stretch").alias("low"), F.max("stretch").alias("high"))
    extents = written(extents.where("low < high and conv_id is not null").select("conv_id", "low"), "extents")
    if extents.take(1):  # conversations of several stretches: their first turns go to all later ones
        side = small_side(extents)
        first = own.join(side, "conv_id").where("stretch = low")
        first = first.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "at")).alias("f")).where("f.role = 'system'")
        later = own.join(side, "conv_id").where("stretch > low").select("conv_id", "alone", "stretch").distinct()
        again = later.join(first, "conv_id").select("conv_id", "alone", "f.turn", "f.role", "f.text", "f.at", "stretch", F.lit(0).alias("kind"))
        every = every.unionByName(again)
    turn = F.struct("kind", "at", "turn", "role", "text")
    convs = every.groupBy("conv_id", "alone", "stretch").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    of_kind = lambda k: F.size(F.filter("turns", lambda t: t["kind"] == k))
    convs = convs.withColumns({"n": F.size("turns"), "n_system": of_kind(0), "n_old": of_kind(0) + of_kind(1)}).where("n > n_old")
    sizes = F.transform("turns", lambda t: tokens(t["text"]))
    convs = convs.withColumn("sizes", sizes)
    sums = F.aggregate(
        "sizes",
        F.array(F.lit(0).cast("long")),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )
    begins = (F.get("turns", F.lit(0))["role"] == "system") & ((F.col("n_system") > 0) | (F.col("n_old") == 0))
    convs = convs.withColumns({"sums": sums, "has_system": begins}).withColumn("reserve", history + F.when(F.col("has_system"), F.get("sizes", F.lit(0))).otherwise(0))
    # starts of windows: the first new turn, and each turn that does not fit behind the last start
    room = lambda start: budget - F.when(start > 0, F.col("reserve")).otherwise(0)
    starts = F.aggregate(
        F.sequence(F.col("n_old") + 1, F.col("n")),
        F.array(F.col("n_old")),
        lambda acc, i: F.when(
            (i > F.element_at(acc, -1) + 1) & (F.get("sums", i) - F.get("sums", F.element_at(acc, -1)) > room(F.element_at(acc, -1))),
            F.concat(acc, F.array(i - 1)),
        ).otherwise(acc),
    )
    convs = convs.withColumn("starts", starts)

    def window(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.col("n"))
        # earlier turns whose tokens, summed back from the start, fit the allowance
        past = F.filter(
            F.sequence(F.lit(0), F.greatest(start - 1, F.lit(0))),
            lambda j: (j < start) & (((j >= F.col("n_system")) & (F.get("sums", start) - F.get("sums", j) <= history)) | (F.col("has_system") & (j == 0))),
        )
        return F.struct(
            F.transform(F.concat(past, F.sequence(start, end - 1)), lambda i: F.get("turns", i)).alias("turns"),
            F.size(past).alias("n_repeated"),
        )

    spans = convs.select("conv_id", "alone", "stretch", F.posexplode(F.transform("starts", window)).alias("window", "span"))

    def head(t: Column) -> Column:
        return F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n"))

    part = lambda t, i: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), ((t["role"] == "assistant") & (i >= F.col("n_repeated"))).alias("loss"))
    spans = spans.select("conv_id", "alone", "stretch", "window", "span.*")
    spans = spans.select("conv_id", "alone", "stretch", "window", "n_repeated", F.transform("turns", part).alias("parts"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    # walk over the parts with the position so far, and note where each loss text stands
    masked = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + F.lit(len(CLOSE))).alias("at"),
            F.when(
                p["loss"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length")))),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return spans.select("conv_id", "alone", "stretch", "window", text.alias("text"), "n_repeated", masked.alias("loss"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted window: array of struct(role, text)."""
    parts = F.split(text, r"<\|im_end\|>\n")
    own = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(len(OPEN) + 1)), "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substr(part, F.length(role) + F.lit(len(OPEN) + 2))).alias("text"),
        )

    return F.transform(own, turn)


def loss_text() -> Column:
    """All text under a window's loss mask, unescaped."""
    return F.array_join(F.transform("loss", lambda s: unescape(F.substr("text", s["start"] + 1, s["length"]))), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, taken from the formatted windows alone. A digest needs the whole conversation in one row."""
    turns = F.filter(parse_turns(F.col("text")), lambda _, i: i >= F.col("n_repeated"))
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = formatted.select(
        "conv_id", "alone",
        F.struct("stretch", "window", F.size(turns).cast("long").alias("n"), flat.alias("flat"), loss_text().alias("loss"), F.length("text").cast("long").alias("chars")).alias("w"),
    )
    rows = parts.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("w")).alias("w"))
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    total = lambda field: F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x[field])
    return rows.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("flat"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
