"""Chat formatting: turns of a raw transcript by a hidden Markov model, then canonical turns.

A transcript is one sequence of lines. It may be stored in several pieces, in order; where
a piece begins or ends tells the model nothing. A line is seen as a small code: the mark it
starts with (a word for a speaker, a dash or time that names nobody, or none), whether it
asks, and its length. Hidden states are the first and the later lines of each role's turn;
their frequencies come from labelled conversations, and Viterbi finds the likeliest states,
which gives bounds and roles of the turns. Each turn is then written as a header with its
role, its text and an end mark.

A conversation may hold a large share of all rows, so it is not decoded in one go. Rows are
range-sorted and cut into blocks. The best paths through a block form a small matrix
(from each state before it to each state at its end); the matrices of a conversation give
the states at the block bounds, and every block is then decoded on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from riskweave.llm.common import fresh
from riskweave.session import materialize

ROLES = ("system", "user", "assistant")
#: Even states open a turn of a role, odd ones go on with it.
STATES = 2 * len(ROLES)
#: Words that transcripts put before a speaker's text.
MARKERS = (
    "system", "sys", "instructions", "user", "human", "customer", "prompter", "you", "question", "q",
    "assistant", "ai", "bot", "model", "agent", "gpt", "answer", "a",
)
_MARKER = rf"(?i)^\s*[#*<|\[]*\s*({'|'.join(MARKERS)})\s*[\]*|>]*\s*[:>]\s*"
#: Marks of a new turn that do not say whose it is: a dash, or a time in brackets.
_MARK = r"^\s*(?:[-\u2013\u2014]\s+|\[\d{1,2}:\d{2}(?::\d{2})?\]\s*)"
LENGTHS = (0, 20, 40, 80, 120, 200, 300)
CODES = (len(MARKERS) + 2) * 2 * (len(LENGTHS) + 1)
BLOCK_BITS = 9
SMOOTHING = 0.5


def line_code(line: Column) -> Column:
    """What the model sees of a line, as one number below ``CODES``."""
    word = F.lower(F.regexp_extract(line, _MARKER, 1))
    marker = F.when(line.rlike(_MARK), F.lit(len(MARKERS) + 1)).otherwise(
        F.array_position(F.lit(list(MARKERS)), word)
    )
    asks = F.rtrim(line).endswith("?")
    length = sum(((F.char_length(line) > n).cast("int") for n in LENGTHS), F.lit(0))
    code = marker * 2 + asks.cast("int")
    return (code * (len(LENGTHS) + 1) + length).cast("int")


def _codes(raw: Column) -> Column:
    lines = F.split(F.coalesce(raw, F.lit("")), "\n")
    return F.transform(lines, line_code)


def ordered_rows(rows: DataFrame, conversation: str, order: str, raw: str, keep: list[str]) -> DataFrame:
    """The rows in transcript order, written down, with the place ``_at`` and their ``_codes``.

    Rows that tie in ``order`` are ordered by a digest of their text; equal rows all stay.
    """
    tied = rows.select(*keep, F.xxhash64(raw).alias("_tie"))
    by = [conversation, order, "_tie"]
    return materialize(
        tied.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_codes", _codes(F.col(raw)))
        .withColumn("_at", F.monotonically_increasing_id()),
        "transcript",
    )


@dataclass(frozen=True)
class RoleModel:
    """Log probabilities: of the first state, of the next state, and of a code in a state."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def matrix(self, codes: np.ndarray) -> np.ndarray:
        """Best score from each state before the lines to each state at their end."""
        out = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)
        for code in codes:
            out = (out[:, :, None] + self.step[None]).max(axis=1) + self.emit[:, code]
        return out

    def opening(self, codes: np.ndarray) -> np.ndarray:
        """As ``matrix``, for the first lines of a conversation: the rows are all alike."""
        score = self.start + self.emit[:, codes[0]]
        for code in codes[1:]:
            score = (score[:, None] + self.step).max(axis=0) + self.emit[:, code]
        return np.tile(score, (STATES, 1))

    def decode(self, codes: np.ndarray, before: int, end: int) -> np.ndarray:
        """The best states of the lines; ``before`` is the state in front, -1 at the start."""
        first = self.start if before < 0 else self.step[before]
        score, back = first + self.emit[:, codes[0]], np.zeros((len(codes), STATES), np.int8)
        for i, code in enumerate(codes[1:], 1):
            ways = score[:, None] + self.step
            back[i] = ways.argmax(axis=0)
            score = ways.max(axis=0) + self.emit[:, code]
        out = np.empty(len(codes), np.int32)
        out[-1] = end
        for i in range(len(codes) - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
        return out


def learn(ordered: DataFrame, conversation: str, role: str) -> RoleModel:
    """A model from the rows of ``ordered`` whose role is one of ``ROLES``; each is one turn.

    Codes are counted over all of them. Steps between rows are counted inside blocks, so a
    conversation over several blocks lends all but one step in ``2 ** BLOCK_BITS`` rows.
    Without such rows all paths are equally likely.
    """
    known = F.array_position(F.lit(list(ROLES)), F.col(role)) - 1
    rows = ordered.withColumn("_opens", (2 * known).cast("int")).where("_opens >= 0")
    seen = (
        rows.select("_opens", F.posexplode("_codes").alias("at", "code"))
        .groupBy((F.col("_opens") + (F.col("at") > 0).cast("int")).alias("state"), "code")
        .count()
        .collect()
    )
    inside = (
        rows.groupBy("_opens")
        .agg(
            F.sum((F.size("_codes") > 1).cast("int")).alias("entered"),
            F.sum(F.greatest(F.size("_codes") - 2, F.lit(0))).alias("stayed"),
        )
        .collect()
    )
    last = F.col("_opens") + (F.size("_codes") > 1).cast("int")
    blocks = rows.groupBy(conversation, F.shiftright("_at", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_opens", last.alias("last")))).alias("_rows")
    )
    steps = (
        blocks.where(F.size("_rows") > 1)
        .select(
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("_rows") - 1),
                    lambda i: F.struct(
                        F.get("_rows", i - 1)["last"].alias("a"), F.get("_rows", i)["_opens"].alias("b")
                    ),
                )
            ).alias("s")
        )
        .groupBy("s.a", "s.b")
        .count()
        .collect()
    )
    starts = (
        rows.groupBy(conversation)
        .agg(F.min(F.struct("_at", "_opens")).alias("_f"))
        .groupBy("_f._opens")
        .count()
        .collect()
    )
    start, step = np.full(STATES, 1e-6), np.full((STATES, STATES), 1e-6)
    emit = np.full((STATES, CODES), SMOOTHING)
    start[::2] = SMOOTHING
    step[:, ::2] += SMOOTHING
    for r in range(len(ROLES)):
        step[2 * r, 2 * r + 1] += SMOOTHING
        step[2 * r + 1, 2 * r + 1] += SMOOTHING
    for state, code, n in seen:
        emit[state, code] += n
    for opens, entered, stayed in inside:
        step[opens, opens + 1] += entered
        step[opens + 1, opens + 1] += stayed
    for a, b, n in steps:
        step[a, b] += n
    for opens, n in starts:
        start[opens] += n
    return RoleModel(*(np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, step, emit)))


def line_states(spark: SparkSession, ordered: DataFrame, conversation: str, model: RoleModel) -> DataFrame:
    """(_at, states): the state of every line of every row of ``ordered``."""
    sent = spark.sparkContext.broadcast(model)

    @arrow_udf(ArrayType(DoubleType()))
    def matrices(codes: pa.Array, opening: pa.Array) -> pa.Array:
        out = [
            (sent.value.opening if o.as_py() else sent.value.matrix)(np.array(c.as_py())).ravel().tolist()
            for c, o in zip(codes, opening, strict=True)
        ]
        return pa.array(out, pa.list_(pa.float64()))

    @arrow_udf(ArrayType(IntegerType()))
    def bounds(matrix: pa.Array) -> pa.Array:
        """States at the end of each block of a conversation."""
        out = []
        for own in matrix:
            blocks = [np.array(m).reshape(STATES, STATES) for m in own.as_py()]
            score = blocks[0][0]
            back = []
            for block in blocks[1:]:
                ways = score[:, None] + block
                back.append(ways.argmax(axis=0))
                score = ways.max(axis=0)
            ends = [int(score.argmax())]
            for choice in reversed(back):
                ends.append(int(choice[ends[-1]]))
            out.append(ends[::-1])
        return pa.array(out, pa.list_(pa.int32()))

    @arrow_udf(ArrayType(IntegerType()))
    def decoded(codes: pa.Array, before: pa.Array, end: pa.Array) -> pa.Array:
        out = [
            sent.value.decode(np.array(c.as_py()), b.as_py(), e.as_py()).tolist()
            for c, b, e in zip(codes, before, end, strict=True)
        ]
        return pa.array(out, pa.list_(pa.int32()))

    blocks = ordered.groupBy(conversation, F.shiftright("_at", BLOCK_BITS).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_codes"))).alias("_rows")
    )
    flat = blocks.select(
        conversation, "_block", "_rows", F.flatten(F.col("_rows._codes")).alias("_codes")
    )
    first = blocks.groupBy(conversation).agg(F.min("_block").alias("_first"))
    flat = materialize(
        flat.alias("x")
        .join(first.alias("y"), F.col(f"x.{conversation}").eqNullSafe(F.col(f"y.{conversation}")))
        .select("x.*", (F.col("_block") == F.col("_first")).alias("_opening")),
        "blocks",
    )
    by_conversation = (
        flat.select(conversation, F.col("_rows")[0]["_at"].alias("_seg"), matrices("_codes", "_opening").alias("_m"))
        .groupBy(conversation)
        .agg(F.sort_array(F.collect_list(F.struct("_seg", "_m"))).alias("_ms"))
        .select("_ms", bounds(F.col("_ms._m")).alias("_ends"))
    )
    ends = by_conversation.select(F.posexplode("_ms").alias("_k", "_s"), "_ends").select(
        F.col("_s._seg").alias("_seg"),
        F.get("_ends", F.col("_k")).alias("_end"),
        F.coalesce(F.get("_ends", F.col("_k") - 1), F.lit(-1)).alias("_before"),
    )
    states = (
        flat.withColumn("_seg", F.col("_rows")[0]["_at"])
        .join(ends, "_seg")
        .select("_rows", decoded("_codes", "_before", "_end").alias("_states"))
    )
    sizes = F.transform("_rows", lambda r: F.size(r["_codes"]))
    cut = states.select("_states", "_rows", sizes.alias("_sizes")).select(
        "_states",
        "_sizes",
        F.posexplode("_rows").alias("_k", "_row"),
    )
    before = F.aggregate(F.slice("_sizes", F.lit(1), F.col("_k")), F.lit(0), lambda a, b: a + b)
    return cut.select(
        F.col("_row._at").alias("_at"),
        F.slice("_states", before + 1, F.size("_row._codes")).alias("states"),
    )


def render(raw: Column, states: Column) -> Column:
    """The piece as canonical turns: ``<|role|>``, the lines, ``<|end|>``.

    A line in an opening state starts a turn and loses its mark; other lines stay as they
    are, whatever they start with. A piece that starts inside a turn goes on without a
    header. Every piece ends with an end mark; where the next one does not open a turn, its
    first lines belong before that mark.
    """
    lines = F.split(F.coalesce(raw, F.lit("")), "\n")

    def said(line: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(line, _MARK, ""), _MARKER, "")

    def role(state: Column) -> Column:
        return F.get(F.lit(list(ROLES)), F.floor(state / 2).cast("int"))

    headed = F.zip_with(
        lines,
        states,
        lambda line, s: F.when(
            s % 2 == 0, F.concat(F.lit("<|end|>\n<|"), role(s), F.lit("|>\n"), said(line))
        ).otherwise(line),
    )
    whole = F.concat(F.array_join(headed, "\n"), F.lit("\n<|end|>"))
    return F.regexp_replace(F.regexp_replace(whole, r"^<\|end\|>\n", ""), r"\n<\|end\|>\n<\|", "<|end|>\n<|").alias("rendered")


def format_chats(
    spark: SparkSession,
    rows: DataFrame,
    *,
    conversation: str = "conv_id",
    order: str = "turn",
    raw: str = "raw",
    role: str = "role",
    train: Column | None = None,
) -> DataFrame:
    """``rows`` with role_pred and opens (both of the first line), n_turns and ``rendered``.

    ``opens`` is whether a turn is found to begin with the row, ``n_turns`` how many begin in
    it. The model is learned from the rows where ``train`` holds and the role is known; a
    prediction sees the lines of the conversation in order and nothing else. A null text is
    one empty line. Rows without a conversation form one together. Columns that have the
    names of results are replaced.
    """
    made = ("role_pred", "opens", "n_turns", "rendered")
    keep = [c for c in rows.columns if c not in made]
    marked = rows.select(*keep, (F.lit(True) if train is None else train).alias("_train"))
    ordered = ordered_rows(marked, conversation, order, raw, [*keep, "_train"])
    model = learn(ordered.where("_train"), conversation, role)
    states = line_states(spark, ordered, conversation, model)
    (found,) = fresh(ordered, "states")
    turns = F.size(F.filter(found, lambda s: s % 2 == 0)).cast("bigint")
    first = F.get(F.lit(list(ROLES)), F.floor(F.col(found)[0] / 2).cast("int"))
    return ordered.join(states.withColumnRenamed("states", found), "_at").select(
        *keep,
        first.alias("role_pred"),
        (F.col(found)[0] % 2 == 0).alias("opens"),
        turns.alias("n_turns"),
        render(F.col(raw), F.col(found)),
    )


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts from a table of turns: what a log would hold instead of the role.

    Chosen by a hash of its place, three in five turns begin with a word for their speaker,
    one with a dash and one with a time, which say that somebody begins but not who. A role
    that is not known has dash or time only. The rows of a conversation, in order, are the
    lines of its transcript; it stays cut into rows because one may be very large.
    """
    pick = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)).cast("int")
    minute = F.lpad((F.coalesce(F.col("turn"), F.lit(0)) % 60).cast("string"), 2, "0")
    unnamed = F.when(pick % 2 == 0, F.concat(F.lit("[10:"), minute, F.lit("] "))).otherwise(F.lit("- "))
    spelled = {
        "system": ("System: ", "[system]: ", "### Instructions: "),
        "user": ("User: ", "Human: ", "Q: "),
        "assistant": ("Assistant: ", "AI: ", "<bot> "),
    }
    marker = unnamed
    for name, forms in spelled.items():
        own = F.coalesce(F.get(F.lit(list(forms)), pick), unnamed)
        marker = F.when(F.col("role") == name, own).otherwise(marker)
    return conversations.withColumn("raw", F.concat(marker, F.coalesce(F.col("text"), F.lit(""))))


def held_out(conversation: str = "conv_id") -> Column:
    """The fifth of the conversations that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(conversation).cast("string"), F.lit(""))) % 5 == 0


def op7(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, held_out, role_pred, opens, n_turns and the rendered turn(s)."""
    rows = transcripts(conversations.select("conv_id", "turn", "role", "text"))
    made = format_chats(spark, rows.drop("text"), train=~held_out())
    return made.select("conv_id", "turn", held_out().alias("held_out"), "role_pred", "opens", "n_turns", "rendered")
