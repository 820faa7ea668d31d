import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from outbreaklens.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    return bpe.tokenizer(RANKS, PATTERN)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain merges: the lowest rank first, the leftmost of equal ones."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[part] for part in parts]


def plain_ids(text: str, encoding) -> list[int]:
    ranks = encoding._mergeable_ranks
    return [i for match in regex.findall(PATTERN, text) for i in merged(match.encode(), ranks)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'stE \n\t.,1é中 \x1c😀"), max_size=60))
def test_pieces_do_not_change_ids(text):
    encoding = bpe.tokenizer(RANKS, PATTERN)
    whole = plain_ids(text, encoding)
    assert bpe.encode_text(encoding, text) == whole
    assert bpe.encode_text(encoding, text, size=3) == whole
    assert "".join(bpe.pieces(text, 3)) == text


def test_long_texts(encoding):
    for text in ("word " * 40_000, "x" * 200_000, " " * 100_000, "a b" * 50_000):
        ids = bpe.encode_text(encoding, text, size=1000)
        assert ids == encoding.encode_ordinary(text)
        assert encoding.decode_bytes(ids) == text.encode()


def test_rows(spark, encoding):
    texts = ["Hello  world", None, "", "<|endoftext|>", "Hello  world", "naïve 中文\r\n"]
    df = spark.createDataFrame([Row(doc_id=i, text=t, coded="x", n_tokens=1) for i, t in enumerate(texts)])
    rows = {r["doc_id"]: r for r in bpe.token_digests(df, RANKS, PATTERN).collect()}
    assert len(rows) == 6 and rows[1] [1:] == rows[2][1:] and rows[1]["n_tokens"] == 0
    assert rows[3]["n_tokens"] > 1
    back = df.select("doc_id", "text", bpe.decode(bpe.encode("text", RANKS, PATTERN), RANKS, PATTERN).alias("b")).collect()
    assert all(bytes(r["b"]) == (r["text"] or "").encode() for r in back)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, None), (1, "a")], "doc_id long, text string")
    assert bpe.token_digests(df, RANKS, PATTERN).count() == 2
    assert bpe.token_digests(df.limit(0), RANKS, PATTERN).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("a'1. \n\t\r\x0b\x1c\x1f\x85\xa0  ​　"), max_size=40))
def test_runs_of_white_space_do_not_change_ids(text):
    encoding = bpe.tokenizer(RANKS, PATTERN)
    for size in (1, 2, 5):
        assert bpe.encode_text(encoding, text, size=size) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("run", [" " * 3_000_000, "\n" * 2_000_000, " \n" * 1_500_000])
def test_runs_of_millions_of_white_space_characters(encoding, run):
    short = run[:1000]
    for text, alike in ((f"one{run}two", f"one{short}two"), (f"one{run}", f"one{short}"), (f"{run}.", f"{short}.")):
        ids = bpe.encode_text(encoding, text)
        assert encoding.decode_bytes(ids) == text.encode()
        same = encoding.encode_ordinary(alike)
        assert ids[0] == same[0] and ids[-1] == same[-1]


def test_lines_without_spaces_are_cut():
    assert max(map(len, bpe.pieces("word\n" * 100_000, 1000))) < 1100
