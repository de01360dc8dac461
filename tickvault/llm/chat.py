r"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole: `<|endoftext|>### role:\n<|endoftext|>text` for each turn, and a last `<|endoftext|>`.
Inside roles and texts a backslash is doubled and `<|endoftext|>` becomes `<\|endoftext|>`, so the mark occurs nowhere
else, and `\x` stands for x. The rendering is encoded once, with offsets; as the mark is a token of its own, no token
lies across the border of a text. The spans of assistant texts are sorted, and a binary search over them tells which
tokens bear loss.

Defined results: null roles and texts are empty; turns of a conversation go by turn (nulls first), then role and text,
and repeated rows are turns of their own; a row without conv_id is a conversation by itself; the query's own
conversation -7 stays apart from one of that id in the table. An empty table gives no rows but that one. Other columns
are not passed on, whatever their names. A conversation is the unit of work: it is rendered by one task, however long.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import table
from tickvault.llm.tokens import encoder, mapped

MARK, SAFE_MARK = "<|endoftext|>", "<\\|endoftext|>"
ESCAPED = re.compile(r"\\(.)", re.S)
FORMATTED = "conv_id bigint, formatted string, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace(MARK, SAFE_MARK)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of assistant texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{MARK}### {escape(role)}:\n{MARK}", escape(text)
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body)
        out += head, body
    return "".join([*out, MARK]), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    parts = formatted.split(MARK)[1:-1]
    return [(unescape(h[4:-2]), unescape(t)) for h, t in zip(parts[::2], parts[1::2])]


def mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[bool]:
    """Whether each token's span and one of the spans have a character in common; both are sorted, and the spans are apart."""
    import numpy as np

    if not spans or not offsets:
        return [False] * len(offsets)
    begin, end = np.array(offsets, "i8").T
    low, high = np.array(spans, "i8").T
    k = np.searchsorted(high, begin, "right")  # the first span that ends after the token begins
    return ((k < len(low)) & (np.append(low, 0)[k] < end)).tolist()


def conversations(rows: DataFrame, apart: str | None = None) -> DataFrame:
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    """conv_id and turns in order. Conversations of one id are told apart by a column, if there is one for that."""
    conv = F.col("conv_id").cast("bigint")
    of = F.lit(0) if apart is None else F.col(apart)
    some = rows.where(conv.isNotNull()).groupBy(conv.alias("conv_id"), of).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return some.select("conv_id", "turns").unionByName(rows.where(conv.isNull()).select(conv.alias("conv_id"), F.array(turn).alias("turns")))


def formatted(rows: DataFrame, path: str | None = None, apart: str | None = None) -> DataFrame:
    """conv_id, formatted, ids, loss: one row a conversation."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column(1).to_pylist()]
        got = encoder(path).tokenizer.encode_batch([text for text, _ in made], add_special_tokens=False)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([text for text, _ in made], pa.string()), pa.array([e.ids for e in got], pa.list_(pa.int32())), pa.array([mask(e.offsets, spans) for e, (_, spans) in zip(got, made)], pa.list_(pa.bool_()))], ["conv_id", "formatted", "ids", "loss"])

    return conversations(rows, apart).mapInArrow(mapped(run), FORMATTED)


def read_back(rows: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, turns (role, text) from the formatted text, and loss_text from the ids under the mask."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        turns = [[{"role": r, "text": t} for r, t in parse(f)] for f in batch.column(1).to_pylist()]
        under = [[i for i, on in zip(ids, loss) if on] for ids, loss in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        loss = [unescape(t) for t in encoder(path).tokenizer.decode_batch(under, skip_special_tokens=False)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(loss, pa.string()), pa.array([len(f) for f in batch.column(1).to_pylist()], pa.int64())], ["conv_id", "turns", "loss_text", "formatted_chars"])

    return rows.mapInArrow(mapped(run), "conv_id bigint, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars bigint")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(0).alias("of"))
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string").withColumn("of", F.lit(1))
    back = read_back(formatted(rows.unionByName(extra), apart="of"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


OP7_SQL = r"""
WITH r AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS own, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, -1, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, -1, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|endoftext|>', '<\|endoftext|>'))
              + length(replace(replace(text, '\', '\\'), '<|endoftext|>', '<\|endoftext|>')) AS n FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(13 + sum(n + 26 + 6) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id, own
"""
