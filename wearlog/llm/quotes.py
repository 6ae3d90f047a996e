"""Chat formatting by quotation linking.

Each message is parsed into nested quote levels (the number of leading ``>``
marks of a line). Its own passages (level 0) and quoted passages (level 1 and
up) are normalised (marks off, white space collapsed, ASCII lower case) and
hashed, by line and by paragraph. A hash of own text names its first message in
the conversation, so a quoted passage joins one original at most, and only one
of an earlier turn; the original that explains most characters at a level wins
(ties: the later turn). The message replies to its level-1 original.

The result has a row per input row with the text without quotes (and without an
attribution line right before one) and its place in the conversation: root (turn
of the first message of its chain of replies), depth, turn. In that order every
message follows the one it answers; rows come out range-partitioned and sorted
by conversation and that order, so a huge conversation spans many tasks.

Null text is empty. Rows with a null conversation or turn are never linked; they
are roots of depth 0. Rows that repeat conversation and turn are one message for
linking and keep a row each. Extra columns are carried along; helper names start
with ``__``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearlog.session import materialize

LEVEL = re.compile(r"\s{0,3}((?:>\s?)*)(.*)", re.S)
SAID = re.compile(r"(?i)\s*(on\b.*\bwrote|.*\b(wrote|writes|said)|le\b.*a écrit|am\b.*schrieb.*|el\b.*escribió)\s*:\s*")
_FOLD = {c: c + 32 for c in range(65, 91)}
UNIT = "__conv long, __turn long, level int, unit long, chars int"


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes, and (level, normalised passage) of every line and paragraph."""
    blocks: list[tuple[int, list[str]]] = []
    own: list[str] = []
    pending = 0
    for line in (text or "").split("\n"):
        marks, rest = LEVEL.fullmatch(line).groups()
        level = marks.count(">")
        words = " ".join(rest.split()).translate(_FOLD)
        if level:
            # an attribution and blank lines between it and the quote go with the quote
            if not pending:
                while own and not own[-1].strip():
                    own.pop()
                if own and SAID.fullmatch(own[-1]):
                    own.pop()
            pending = 1
        else:
            pending = 0
            own.append(line)
        if not words:
            blocks.append((level, []))
        elif blocks and blocks[-1][0] == level and blocks[-1][1]:
            blocks[-1][1].append(words)
        else:
            blocks.append((level, [words]))
    units = {}
    for level, lines in blocks:
        if level == 0:
            lines = [x for x in lines if not SAID.fullmatch(x)]
        for passage in [*lines, " ".join(lines)]:
            if passage:
                units[level, passage] = None
    return "\n".join(own).strip("\n"), list(units)


def _unit(passage: str) -> int:
    return int.from_bytes(hashlib.blake2b(passage.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def quoted_units(messages: DataFrame) -> DataFrame:
    """One row per passage of a message: level, hash and length."""

    def units(batches):
        for batch in batches:
            conv, turn, texts = (c.to_pylist() for c in batch.columns)
            for a in range(0, len(texts), 256):
                rows = [(c, t, lv, _unit(p), len(p)) for c, t, x in zip(conv[a : a + 256], turn[a : a + 256], texts[a : a + 256], strict=True) for lv, p in parse(x)[1]]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()], strict=True)],
                        names=["__conv", "__turn", "level", "unit", "chars"],
                    )

    slim = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("__conv"), F.col("turn").cast("long").alias("__turn"), F.col("text").cast("string")
    )
    return slim.mapInArrow(units, UNIT)


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv, turn, level) -> the turn quoted there; one row per message and quote level that has an original."""
    units = materialize(quoted_units(messages), "quote-units").distinct()
    quoted = units.where("level > 0")
    # originals: the first message with the passage, of passages somebody quotes
    used = quoted.select("__conv", "unit").distinct()
    first = units.where("level = 0").join(used, ["__conv", "unit"], "left_semi").groupBy("__conv", "unit").agg(F.min("__turn").alias("quoted"))
    joined = quoted.join(first, ["__conv", "unit"]).where("quoted < __turn")
    by = joined.groupBy("__conv", "__turn", "level", "quoted").agg(F.sum("chars").alias("chars"))
    return by.groupBy("__conv", "__turn", "level").agg(F.max_by("quoted", F.struct("chars", "quoted")).alias("quoted"))


def reply_chains(links: DataFrame) -> DataFrame:
    """(conv, turn) of every reply -> reply_to, root, depth, by pointer doubling (turns about the logarithm of the longest chain)."""
    up = links.where("level = 1").select("__conv", "__turn", F.col("quoted").alias("reply_to"))
    state = materialize(up.select("__conv", "__turn", "reply_to", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth")), "quote-chains")
    while True:
        hop = state.select("__conv", F.col("__turn").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        state_next = state.join(hop, ["__conv", "root"], "left").select(
            "__conv", "__turn", "reply_to", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")
        )
        state_next = materialize(state_next, "quote-chains")
        moved = state_next.where("moved").limit(1).count()
        state = state_next.drop("moved")
        if not moved:
            return state


#: Columns of the result besides the input's.
OWN = ("reply_to", "root", "depth", "own_text")


def conversations(messages: DataFrame) -> DataFrame:
    """All rows in reply order: the input's columns, then reply_to, root, depth, own_text.

    An input column of one of those four names (in any case) is carried as ``in_<name>``.
    """
    chains = reply_chains(quote_links(messages)).withColumnsRenamed({"reply_to": "__reply_to", "root": "__root", "depth": "__depth"})
    place = {c: f"__{i}" for i, c in enumerate(messages.columns)}
    at = messages.columns.index("text")

    def strip(batches):
        for batch in batches:
            own = [None if t is None else parse(t)[0] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string())], names=[*names, "__own"])

    names = list(place.values())
    plain = messages.withColumn("text", F.col("text").cast("string")).toDF(*names)
    plain = plain.mapInArrow(strip, T.StructType([*plain.schema.fields, T.StructField("__own", T.StringType())]))
    conv, turn = place["conv_id"], place["turn"]
    out = plain.join(chains, (F.col(conv) == F.col("__conv")) & (F.col(turn) == F.col("__turn")), "left").select(
        *(F.col(p).alias(f"in_{c}" if c.lower() in OWN else c) for c, p in place.items()),
        F.col("__reply_to").alias("reply_to"), F.coalesce("__root", turn).alias("root"), F.coalesce("__depth", F.lit(0)).alias("depth"), F.col("__own").alias("own_text"),
    )
    return out.repartitionByRange("conv_id", "root", "depth", "turn").sortWithinPartitions("conv_id", "root", "depth", "turn")
