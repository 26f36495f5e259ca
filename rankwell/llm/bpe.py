"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts above this many characters are handed to the encoder in pieces; the ids are the same.
PIECE_CHARS = 20_000
#: White space as the split pattern sees it; `re` and `str.split` count U+001C to U+001F as well.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Between a visible character and white space a match of the usual split patterns always ends.
SAFE = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
#: White space that the split pattern would walk back over character by character.
LONG_SPACE = re.compile(f"[{_SPACE}]{{1000,}}")


@functools.cache
def encoder(rank_file: str, pattern: str):
    """The encoder of a rank file; once in each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of `size` characters or slightly more, cut only where the split pattern cuts anyway."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """Long white space apart from the rest, each part with whether it is one match of the split pattern.

    Of a run of white space the pattern takes all but the last character as one match where something follows (the
    last may go with a word), and all of it at the end of the text.
    """
    start = 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() - (run.end() < len(text))
        yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    yield text[start:], False


def encode_text(text: str, rank_file: str, pattern: str) -> list[int]:
    """Ids of one whole text, without special tokens. `pattern` is one of the usual kind, as `parts` reads it."""
    codec = encoder(rank_file, pattern)
    if len(text) <= PIECE_CHARS:
        return codec.encode_ordinary(text)
    ids: list[int] = []
    for part, whole in parts(text):
        if whole:
            ids += codec._core_bpe.encode_single_piece(part.encode())
        else:
            for piece in pieces(part):
                ids += codec.encode_ordinary(piece)
    return ids


def encode_decode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id", ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Per row: id, the token ids of the whole text (array<int>) and the bytes that those ids decode to.

    Null and empty texts give no ids and empty bytes. Repeated rows give repeated results, other columns are
    left out whatever their names, an empty table gives an empty one. Each row stands alone, so nothing is
    shuffled and a lost task is simply run again.
    """
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(rank_file, pattern).decode_bytes
        for batch in batches:
            ids, back, first, chars = [], [], 0, 0
            texts = batch.column(1).to_pylist()
            for row, text in enumerate(texts):
                ids.append(encode_text(text or "", rank_file, pattern))
                back.append(decode(ids[-1]))
                chars += len(text or "")
                if chars > 4_000_000 or row == len(texts) - 1:
                    made = [batch.column(0).slice(first, len(ids)), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.binary())]
                    yield pa.RecordBatch.from_arrays(made, names=[id_col, ids_col, bytes_col])
                    ids, back, first, chars = [], [], row + 1, 0

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def op6_byte_bpe(spark: SparkSession, docs: DataFrame, rank_file: str | None = None) -> DataFrame:
    """Digest of `encode_decode` over whole documents: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    made = encode_decode(docs, rank_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
