"""Token-ID files: encode documents in ascending order, write Simple-8b segments, read them back by document."""

from __future__ import annotations

import functools
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm import simple8b
from rankwell.llm.common import shared_dir

#: Ids after which a segment is closed; one document may exceed it.
SEGMENT_IDS = 1 << 20
#: Segments up to which their starts (three integers each) are broadcast to the readers; beyond, they are joined.
FEW_SEGMENTS = 100_000
#: Pieces of words whose ids a worker keeps; beyond it those that the texts at hand do not hold are forgotten.
CACHE_PIECES = 300_000
#: Bytes of text that are encoded at once.
SLICE_BYTES = 10_000_000
#: Words with other characters go through the whole tokenizer: lower case or composition may treat those in context,
#: and some of them are white space to some libraries only.
_PLAIN = r"^[\x00-\x{1b} -\x{84}\x{86}-\x{9f}\x{a1}-\x{24f}]*$"
_END = b"\xff\xff\xff\xff"
#: The normalizer and the split (fixed values of the tokenizer file) that `WordEncoder` can follow word by word.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class WordEncoder:
    """Ids by the tokenizers library, each distinct word of a slice of texts encoded once.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words in turn.
    Words of Latin letters are cut by the tokenizer's own split pattern and each distinct piece goes to its BPE
    model; any other word goes through the whole tokenizer. Texts with special tokens go through it whole, and so
    does every text of a tokenizer whose file states another normalizer, split or kind of model.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as stated:
            stated = json.load(stated)
        split = {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
        added = stated["added_tokens"]
        self.by_words = (stated["normalizer"], stated["pre_tokenizer"], stated["model"]["type"], stated["truncation"]) == (_NORMALIZER, split, "BPE", None) and all(t["special"] and not t["normalized"] for t in added)
        self.special = sorted(t["content"] for t in added)
        self.cut = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.alphabet = byte_alphabet()
        self.pieces: dict[str, bytes] = {"\n": _END}

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32) for text in texts]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)

    def _vocabulary(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and how many each has."""
        plain = pc.match_substring_regex(words, _PLAIN)
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        row = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pc.if_else(plain, words, ""))
        cut = self.cut(pc.binary_join(row, pa.scalar("\n", pa.large_string()))[0].as_py().lower() + "\n")
        distinct = set(cut)
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {piece: self.pieces[piece] for piece in distinct.intersection(self.pieces)}
        for piece in distinct.difference(self.pieces):
            spelled = piece if piece.isascii() and piece.isprintable() else "".join(map(self.alphabet.__getitem__, piece.encode()))
            self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        pool = np.frombuffer(b"".join(map(self.pieces.__getitem__, cut)), np.uint32)
        ends = np.flatnonzero(pool == 0xFFFFFFFF)
        sizes = np.diff(ends, prepend=-1) - 1
        pool = pool[pool != 0xFFFFFFFF]
        if len(odd):
            ids, lengths = self._whole(words.take(pa.array(odd)).to_pylist())
            pool = np.insert(pool, np.repeat((np.cumsum(sizes) - sizes)[odd], lengths), ids)
            sizes[odd] = lengths
        return pool, sizes

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words or any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            return self._whole(texts.to_pylist())
        split = pc.ascii_split_whitespace(texts)
        edges = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        pool, sizes = self._vocabulary(coded.dictionary)
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(pool))
        ids = lists.take(coded.indices).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy(zero_copy_only=False)])])
        return ids, np.diff(ends[edges - edges[0]])


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE_BYTES of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        limit = (sizes[first - 1] if first else 0) + SLICE_BYTES
        last = max(first + 1, int(np.searchsorted(sizes, limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int = 2, text_col: str = "text", id_col: str = "doc_id") -> None:
    """Encode every whole text and write the ids, in ascending id order, as Simple-8b segments below `path`.

    Rows of the written table: `shard` (ascending with the ids), `segment` (from 0 in each shard), `n_docs`,
    `n_ids`, `data` (the bytes of `simple8b.to_bytes`). Null and empty texts hold the end id alone; a null id
    comes first; rows that share an id keep every copy, in the order of a hash of their texts. Other columns are ignored.
    Texts are dealt by ranges of the id, of about equal rows, so no source and no group of copies meets in one
    task, and each task holds one segment at a time.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = dealt.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = segment = 0

        def close() -> pa.RecordBatch:
            docs, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            data = simple8b.to_bytes(docs, lengths, ids)
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([int(docs[0])], pa.int64()), pa.array([data], pa.binary())], names=["segment", "n_docs", "n_ids", "first_id", "data"])

        for batch in batches:
            for part in slices(batch):
                ids, lengths = encoder.batch(part.column(1))
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, end_id)
                docs = part.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                held.append((docs, lengths + 1, ids))
                size += len(ids)
                if size >= SEGMENT_IDS:
                    yield close()
                    held, size, segment = [], 0, segment + 1
        if held:
            yield close()

    made = dealt.mapInArrow(run, "segment long, n_docs long, n_ids long, first_id long, data binary")
    made.withColumn("shard", F.spark_partition_id()).write.option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Documents of a token file: id, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`, `ids`.

    Segment starts come from the table of segments alone (one short row each): running sums within a shard, and
    sums of whole shards before it, so no task reads more than its own segments.
    """
    schema = "segment long, n_docs long, n_ids long, first_id long, data binary, shard int"
    table = spark.read.schema(schema).parquet(path)
    shards = table.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = shards.select("shard", F.coalesce(F.sum("size").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = W.partitionBy("shard").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    index = table.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")).join(before, "shard")
    starts = index.select(F.col("shard").alias("s"), F.col("segment").alias("g"), (F.col("base") + F.col("inside")).alias("at"))
    if table.count() <= FEW_SEGMENTS:
        starts = F.broadcast(starts)
    opened = table.select("shard", "segment", "data").join(starts, (F.col("shard") == F.col("s")) & (F.col("segment") == F.col("g"))).select("at", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, lengths, ids = simple8b.from_bytes(data.as_buffer())
                ids = ids.astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                names = pa.array(docs, pa.int64(), mask=docs == -(1 << 63))
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, ends[-1:]), pa.int32()), pa.array(ids.astype(np.int64), pa.int64()))
                made = [names, pa.array(begins + at, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(made, names=[id_col, "start", "n_tokens", "ids_crc32", "ids"])

    return opened.mapInArrow(run, f"{id_col} long, start long, n_tokens long, ids_crc32 long, ids array<bigint>")


def op4_simple8b_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token file of the documents, read it back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    path = shared_dir(spark)
    write_tokens(docs, path, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
