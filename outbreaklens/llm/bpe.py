"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A text is cut in front of white space after a non-space character before it is encoded. The split pattern always
starts a match at such a place and looks at nothing behind it, so the ids of the pieces, one after another, are the
ids of the whole text, and no call works on more than one piece. Of a run of white space in front of a non-space
character all but the last character is one match of the pattern, and a run at the end of the text is one whole
match: such a match, if long, is merged without the pattern, which would backtrack over it. Text without white space
stays in one piece. Special tokens are never produced: their spelling is ordinary text.

A null text counts as empty: no ids, no bytes. Decoding concatenates the raw bytes of the ranks, which need
not be valid UTF-8 for an arbitrary list of ids; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what \s is in the split pattern
BOUNDARY = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
ENCODED = "struct<ids:array<int>,decoded:binary>"


@cache
def tokenizer(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; read once in every Python worker."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _cut(text: str, start: int, end: int, size: int) -> Iterator[str]:
    """Cut at the first safe place after every `size` characters."""
    while end - start > size:
        place = BOUNDARY.search(text, start + size, end)
        if place is None:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:end]


def _matched(text: str, size: int) -> Iterator[tuple[str, bool]]:
    """The pieces of a text, and whether a piece is one match of white space."""
    at = 0
    for run in re.finditer(f"(?<![{SPACE}])[{SPACE}]{{{max(size, 2)},}}", text):
        end = run.end() - (run.end() < len(text))
        yield from ((piece, False) for piece in _cut(text, at, run.start(), size))
        yield text[run.start() : end], True
        at = end
    yield from ((piece, False) for piece in _cut(text, at, len(text), size))


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about `size` characters; long runs of white space are pieces of their own."""
    return (piece for piece, _ in _matched(text, size))


def encode_text(encoding: tiktoken.Encoding, text: str | None, size: int = PIECE_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    return [
        i
        for piece, single in _matched(text, size)
        for i in (encoding._encode_single_piece(piece) if single else encoding.encode_ordinary(piece))
    ]


def _encoded(encoding: tiktoken.Encoding, texts: pa.Array, decoded: list[bytes] | None = None) -> pa.Array:
    """Id lists of a batch; `decoded` takes the bytes of each list.

    Text by text, four bytes an id: a batch never stands in memory as Python numbers.
    """
    parts, ends = [], [0]
    for text in texts:
        ids = encode_text(encoding, text.as_py())
        parts.append(np.array(ids, np.int32))
        ends.append(ends[-1] + len(ids))
        if decoded is not None:
            decoded.append(encoding.decode_bytes(ids))
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(text: Column | str, rank_file: str, pattern: str) -> Column:
    """Token ids of a text column."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return _encoded(tokenizer(rank_file, pattern), texts)

    return run(text)


def decode(ids: Column | str, rank_file: str, pattern: str) -> Column:
    """Raw bytes of a column of id lists."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        encoding = tokenizer(rank_file, pattern)
        return pa.array([encoding.decode_bytes(one.as_py() or []) for one in lists], pa.binary())

    return run(ids)


def round_trip(text: Column | str, rank_file: str, pattern: str) -> Column:
    """`encode` and `decode` of its ids in one pass over the rows: a struct of ids and decoded bytes."""

    @F.arrow_udf(ENCODED)
    def run(texts: pa.Array) -> pa.Array:
        decoded: list[bytes] = []
        ids = _encoded(tokenizer(rank_file, pattern), texts, decoded)
        return pa.StructArray.from_arrays([ids, pa.array(decoded, pa.binary())], ["ids", "decoded"])

    return run(text)


def token_digests(df: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded bytes of every row.

    One row per row of `df`, repeated rows included; other columns are not read. The digests are computed in
    the JVM from the ids and bytes that `round_trip` returns.
    """
    coded = df.select(F.col(key), round_trip(text, rank_file, pattern).alias("coded"))
    return coded.select(
        key,
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("coded.ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded"), 256).alias("decoded_sha256"),
    )
