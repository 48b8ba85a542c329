"""Chat formatting: token-level assembly of conversations.

A turn becomes: the reserved id of its role, its text's tokens, the reserved id
of the turn's end.  A role without an id of its own is written out between two
reserved ids.  Texts are encoded apart from each other and from the marks, so
no token spans a boundary; a mask of assistant text comes from prefix sums of
the segments' starts and ends.  Where a text holds a control string, one
backslash goes in after its first character (one more, where there are some),
so the formatted text, too, reads back to exactly the turns it was made from.

Turns stand for themselves, so formatting needs no shuffle; only what reads a
conversation as a whole (``conversation_digests``) brings its turns together, in
order and a batch at a time, so a conversation may be of any length.

Defined results: null text and null role count as empty; a null conversation
id is one conversation; turns of equal number are in the order of their
formatted text, repeated rows are repeated turns; a null turn number comes
first; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text before byte pairs are merged; belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Control strings; their ids follow the vocabulary's in this order.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[/ROLE]")
ROLE_MARKS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]"}
END = "</s>"
LEARNED_ROLE = "assistant"

_CONTROL = re.compile("|".join(rf"(?:{re.escape(c[0])})(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"({re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


class Codec:
    """Byte-pair codec with the control strings' ids after the vocabulary's."""

    def __init__(self, lines: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.bpe = tiktoken.Encoding("byte-pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1
        self.ids = {c: self.first + k for k, c in enumerate(CONTROLS)}

    def text(self, ids: list[int]) -> str:
        return self.bpe.decode_bytes(ids).decode("utf-8")


@lru_cache(maxsize=2)
def _codec(lines: bytes) -> Codec:
    return Codec(lines)


def turn_segments(codec: Codec, role: str, text: str) -> tuple[list[list[int]], str]:
    """Token segments of one turn, the learned text third, and its formatted text."""
    ids, body = codec.ids, escape(text)
    if role in ROLE_MARKS:
        head, shown = [ids[ROLE_MARKS[role]]], ROLE_MARKS[role]
    else:
        name = escape(role)
        head = [ids["[ROLE]"], *codec.bpe.encode_ordinary(name), ids["[/ROLE]"]]
        shown = f"[ROLE]{name}[/ROLE]"
    return [head, codec.bpe.encode_ordinary(body), [ids[END]]], shown + body + END


def read_turn(codec: Codec, ids: np.ndarray) -> tuple[str, str]:
    """Role and text of one turn's ids."""
    marks = {codec.ids[m]: r for r, m in ROLE_MARKS.items()}
    if ids[0] in marks:
        return marks[int(ids[0])], unescape(codec.text(ids[1:-1].tolist()))
    cut = int(np.flatnonzero(ids == codec.ids["[/ROLE]"])[0])
    return unescape(codec.text(ids[1:cut].tolist())), unescape(codec.text(ids[cut + 1:-1].tolist()))


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())   # one vocabulary file


def format_turns(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, formatted, ids, mask) of each row; mask 1 on learned tokens."""
    lines = _vocabulary(conversations.sparkSession, vocabulary)

    def run(batches):
        codec = _codec(lines.value)
        for batch in batches:
            shown, segments, rows = [], [], [0]
            opens, closes = [], []
            at = 0
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                parts, formatted = turn_segments(codec, role or "", text or "")
                shown.append(formatted)
                if (role or "") == LEARNED_ROLE:
                    opens.append(at + len(parts[0]))
                    closes.append(at + len(parts[0]) + len(parts[1]))
                segments.extend(parts)
                at += sum(map(len, parts))
                rows.append(at)
            edges = np.zeros(at + 1, np.int32)
            np.add.at(edges, np.array(opens, np.int64), 1)
            np.add.at(edges, np.array(closes, np.int64), -1)
            mask = np.cumsum(edges)[:at].astype(np.int8)
            offsets = pa.array(rows, pa.int32())
            flat = np.fromiter((t for s in segments for t in s), np.int32, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shown, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(mask))],
                names=["conv_id", "turn", "formatted", "ids", "mask"])

    kinds = conversations.schema
    return (conversations.select("conv_id", "turn", "role", "text")
            .mapInArrow(run, f"conv_id {kinds['conv_id'].dataType.simpleString()}, turn {kinds['turn'].dataType.simpleString()}, "
                             "formatted string, ids array<int>, mask array<tinyint>"))


DIGEST_SCHEMA = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the formatted turns of each conversation read back to."""
    lines = _vocabulary(turns.sparkSession, vocabulary)
    names = ["conv_id", *(f.split()[0] for f in DIGEST_SCHEMA.split(", "))]
    kind = turns.schema["conv_id"].dataType

    def run(batches):
        codec = _codec(lines.value)
        done: list[tuple] = []
        now, state = None, None

        def close():
            if state is not None:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def out():
            arrays = [pa.array(c, batch_kind if k == 0 else pa.string() if k in (2, 4) else pa.int64())
                      for k, c in enumerate(zip(*done))]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        batch_kind = None
        for batch in batches:
            batch_kind = batch.schema.field(0).type
            ids, masks = batch.column(3), batch.column(4)
            flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
            learned = masks.values.to_numpy().astype(bool)
            for row, (conv, formatted) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                own = flat[at[row]:at[row + 1]]
                role, text = read_turn(codec, own)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                loss = unescape(codec.text(own[learned[at[row]:at[row + 1]]].tolist()))
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(formatted)
            if len(done) > 10_000:
                yield out()
                done = []
        close()
        if done:
            yield out()

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, {DIGEST_SCHEMA}")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return conversation_digests(format_turns(given.unionByName(more)))


OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]|\[\\*SYS\]')) + 4 + CASE role
        WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 WHEN 'system' THEN 5
        ELSE length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]|\[\\*SYS\]')) + 13 END AS shown FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
