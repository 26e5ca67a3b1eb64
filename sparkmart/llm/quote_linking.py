"""Chat formatting by quotation linking (operator 4).

A message's lines are read with their quote level (the number of ``>`` before
the text); runs of one level are passages. Quoted passages are normalised
(case folded, white space and outer punctuation dropped), hashed, and joined to
the messages of the same conversation whose own (unquoted) text, paragraph or
line has that hash; the first such message before the quoting one is the
original. A message replies to the original of its shallowest linked quote
(the first of them). Conversations come as messages without quotes, in reply
order: by ``thread`` (the turn of the thread's first message), then ``turn``,
so every reply stands behind its original; ``in_order`` numbers them.

A passage that is not found as a whole is looked up line by line. "On ...
wrote:" lines right before a quote belong to the quote. Each quoted passage
meets one original at most, so repeated lines make no pairs, and no
conversation is gathered in one place.

Cases: null and empty texts are messages without text or quotes; null
conversation ids or turns link to nothing and keep their message; quotes
without an original leave ``reply_to`` null; repeated rows give repeated
results; of several messages of one conversation and turn, a quote of any
links to that turn; extra columns are not read.
"""

from __future__ import annotations

import re
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import map_arrow, written
from sparkmart.operators.relational import with_surrogate_key

_QUOTE = re.compile(r"(?:[ \t]*>)+")
_ATTRIBUTION = re.compile(r"\s*on .* wrote:\s*", re.IGNORECASE)
_EDGE = re.compile(r"^\W+|\W+$")


def passages(text: str | None) -> list[tuple[int, list[str]]]:
    """(level, lines) of the runs of one quote level, in order."""
    out: list[tuple[int, list[str]]] = []
    lines = re.split(r"\r?\n", text) if text else []
    cut = []
    for line in lines:
        m = _QUOTE.match(line)
        cut.append((m.group().count(">"), line[m.end():].strip()) if m else (0, line))
    for i, (level, body) in enumerate(cut):
        if level == 0 and i + 1 < len(cut) and cut[i + 1][0] and _ATTRIBUTION.fullmatch(body):
            continue
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return out


def fingerprint(text: str) -> int | None:
    """64-bit hash of the normalised text; None if nothing is left of it."""
    norm = _EDGE.sub("", " ".join(text.casefold().split()))
    return int.from_bytes(blake2b(norm.encode(), digest_size=8).digest(), "big", signed=True) if norm else None


def parse(text: str | None) -> dict:
    """Own text, the hashes it can be quoted by, and the quoted passages'
    hashes as (level, passage, place, hash): place 0 is the whole passage."""
    runs = passages(text)
    own = "\n".join("\n".join(lines) for level, lines in runs if not level).strip()
    units = {fingerprint(own)}
    for level, lines in runs:
        if not level:
            units.update(map(fingerprint, lines))
            units.update(map(fingerprint, re.split(r"\n\s*\n", "\n".join(lines))))
    quotes = []
    for no, (level, lines) in enumerate((r for r in runs if r[0])):
        whole = [fingerprint(" ".join(lines)), *(fingerprint(x) for x in lines)]
        quotes += [{"level": level, "passage": no, "place": i, "hash": h} for i, h in enumerate(whole) if h is not None]
    return {"own": own, "units": sorted(units - {None}), "quotes": quotes,
            "n_quotes": sum(1 for level, _ in runs if level)}


def link(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, reply_to, thread, n_quotes, n_linked, text) per row."""
    src = df.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                    F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))

    def run(cols):
        got = [parse(t) for t in cols["text"]]
        return {**{c: cols[c] for c in ("conv_id", "turn", "role")}, **{c: [g[c] for g in got] for c in ("own", "units", "quotes", "n_quotes")}}

    parsed = written(map_arrow(src, run, "conv_id bigint, turn bigint, role string, own string, units array<bigint>, "
                                         "quotes array<struct<level:int,passage:int,place:int,hash:bigint>>, n_quotes int"), "messages")
    known = parsed.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    units = known.select("conv_id", "turn", F.explode("units").alias("hash"))
    first = units.groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    quotes = known.where(F.size("quotes") > 0).select("conv_id", "turn", F.xxhash64("quotes").alias("key"), F.explode("quotes").alias("q"))
    met = quotes.select("conv_id", "turn", "key", "q.*").join(first, ["conv_id", "hash"]).where(F.col("origin") < F.col("turn"))
    per = met.groupBy("conv_id", "turn", "key", "level", "passage").agg(F.min_by("origin", "place").alias("origin"))
    reply = per.groupBy("conv_id", "turn", "key").agg(
        F.min(F.struct("level", "passage", "origin"))["origin"].alias("reply_to"), F.count("*").cast("int").alias("n_linked"))
    reply = written(reply, "replies")
    roots = _roots(reply.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("top")))
    out = parsed.withColumn("key", F.xxhash64("quotes")).join(reply, ["conv_id", "turn", "key"], "left").join(
        roots, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "reply_to", F.coalesce("top", "turn").alias("thread"), "n_quotes",
                      F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("own").alias("text"))


def _roots(up: DataFrame) -> DataFrame:
    """(conv_id, turn, top): the first message of the thread, by pointer jumping
    (the number of rounds is the logarithm of the longest chain)."""
    up = written(up, "threads")
    while True:
        above = up.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next"))
        new = written(up.join(above, ["conv_id", "top"], "left").select(
            "conv_id", "turn", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")), "threads")
        up = new.select("conv_id", "turn", "top")
        if new.where("moved").isEmpty():
            return up


def in_order(messages: DataFrame) -> DataFrame:
    """``messages`` of ``link`` with ``position``: the place (from 1) in the reply
    order of the conversation, messages of one turn by their other columns; null
    where conversation or turn is. All rows are sorted by range and numbered
    through, less the number at which their conversation begins, so a conversation
    may lie in many tasks."""
    order = [F.col("conv_id"), F.col("thread").asc_nulls_last(), F.col("turn"), F.col("role"), F.col("text"),
             F.col("reply_to"), F.col("n_quotes"), F.col("n_linked")]
    placed = with_surrogate_key(messages, "_place", order)
    begins = placed.groupBy("conv_id").agg(F.min("_place").alias("_begin"))
    return placed.join(begins, "conv_id", "left").withColumn(
        "position", F.when(F.col("turn").isNotNull(), F.col("_place") - F.col("_begin") + 1)).drop("_place", "_begin")


def render(messages: DataFrame) -> DataFrame:
    """``messages`` with ``chat``: the message as a block of a chat transcript; by
    ``position`` they make the conversation."""
    return messages.withColumn("chat", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text", F.lit("\n<|end|>")))
