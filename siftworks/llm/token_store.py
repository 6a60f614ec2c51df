"""Token-ID store: Parquet list columns, dictionary and delta encoded.

Documents are range-partitioned by id, encoded on the executors with the
``tokenizers`` library and written by Spark's own Parquet writer, so a lost
executor costs a task and the commit protocol leaves no half-written file.
Each row holds ``doc_id, part, part_start, n_tokens, tokens``: ``part`` is the
range partition (files in ascending id order) and ``part_start`` the ids before
the document inside it.  A manifest with one row a part gives the global
offset.  Token ids are dictionary encoded, the integer metadata columns delta
encoded; row groups and pages are bounded, and the column and offset indexes
that the writer adds let readers skip pages, so metadata reads never touch the
token pages and a doc_id range reads only its own pages.
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.llm.common import LETTERS, NUMBERS, SPACES, LatinCutter, PieceLists, hold, ship_package, slices, text_of, work_dir

SPLIT = rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}{SPACES}]+"
#: The tokenizer's own pattern, which SPLIT spells out for Latin-1.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class TextEncoder(PieceLists):
    """Encodes texts by their distinct pieces, exactly as the tokenizer encodes
    whole texts.

    The tokenizer drops white space, lower-cases, cuts words by a pattern and
    merges inside the cuts only, so a piece has the same ids in every text.
    A batch of texts is cut by the classes of its bytes, and pieces that are
    new are merged by the tokenizer's BPE model.  Words with a character beyond
    Latin-1 stay whole and go through the whole tokenizer.  A tokenizer of
    another layout encodes whole texts.
    """

    def __init__(self, path: str, end_id: int, limit: int = 48 << 20):
        import json
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end_id = end_id
        state = lambda part: json.loads(part.__getstate__()) if part else {}
        steps = state(self.tokenizer.pre_tokenizer).get("pretokenizers", [])
        kinds = [x["type"] for x in state(self.tokenizer.normalizer).get("normalizers", [])]
        #: Pieces hold for this layout of normaliser and splitter only.
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"].get("Regex") == PATTERN
        self.split = re.compile(SPLIT).findall
        self.letters = _byte_letters()
        super().__init__(LatinCutter(SPACES, LETTERS, NUMBERS, alone=2, quoted=1), limit)

    def merged(self, piece: str) -> list[int]:
        """Ids of a lower-case piece of Latin-1 characters."""
        return [t.id for t in self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]

    def make(self, piece: str) -> list[int]:
        if not _latin(piece):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        if piece.isalpha():
            return self.merged(piece)
        # white space has no cut; a quote before letters may have two
        return [i for p in self.split(piece) for i in self.merged(p)]

    def encode(self, texts):
        """Flat int32 ids of an Arrow string array's texts, each with its end
        id, and their counts; null texts are empty."""
        import numpy as np

        if not self.plain:
            got = [self.tokenizer.encode(t.as_py() or "", add_special_tokens=False).ids + [self.end_id] for t in texts]
            return np.array([i for g in got for i in g], np.int32), np.array([len(g) for g in got], np.int64)
        ids, upto = self.strung(texts)
        return np.insert(ids, upto, self.end_id), np.diff(upto, prepend=0) + 1


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the code points from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


STORE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, tokens array<int>"


def write_tokens(
    df: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 128 << 10,
    page_rows: int = 2000,
    codec: str = "zstd",
    path: str | None = None,
) -> str:
    """Encode every text of ``df`` into a token store; returns its path.

    Null texts are empty and yield the end id alone; empty texts likewise.
    Rows with a null id are kept and come first.  Repeated ids are kept, next
    to each other, ordered by text.  An empty input gives an empty store.
    Strings of special tokens inside a text are ordinary text.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = path or work_dir(spark, "tokens")

    def encode(batches):
        import pyarrow as pa

        encoder = hold(("encoder", tokenizer_path, end_id), lambda: TextEncoder(tokenizer_path, end_id))
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, 2 << 20, "text"):
                if not batch.num_rows:
                    continue
                ids, per = encoder.encode(batch.column("text"))
                offsets = pa.array([0, *per.cumsum()], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([part] * len(per), pa.int32()),
                        pa.array(before + per.cumsum() - per, pa.int64()),
                        pa.array(per, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "tokens"],
                )
                before += int(per.sum())

    (
        df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, STORE_SCHEMA)
        .write.options(
            **{
                "compression": codec,
                "parquet.block.size": row_group_bytes,
                "parquet.page.size": page_bytes,
                "parquet.page.row.count.limit": page_rows,
                "parquet.writer.version": "PARQUET_2_0",
                "parquet.enable.dictionary": "true",
                "parquet.enable.dictionary#doc_id": "false",
                "parquet.enable.dictionary#part_start": "false",
                "parquet.enable.dictionary#n_tokens": "false",
            }
        )
        .parquet(path)
    )
    return path


def read_tokens(spark: SparkSession, path: str, *, with_tokens: bool = True) -> DataFrame:
    """Rows of a store with their global ``start``.

    Without tokens only the metadata pages are read.  A filter on doc_id
    reaches the scan and skips row groups and pages.  The manifest that is
    joined has one row a file of the store, 20 bytes each.
    """
    store = spark.read.schema(STORE_SCHEMA).parquet(path)
    manifest = (
        store.groupBy("part")
        .agg(F.sum("n_tokens").alias("held"))
        .select("part", (F.sum("held").over(W.orderBy("part")) - F.col("held")).alias("offset"))
    )
    kept = store if with_tokens else store.drop("tokens")
    return kept.join(F.broadcast(manifest), "part").withColumn("start", F.col("offset") + F.col("part_start")).drop("part", "part_start", "offset")


def token_digests(store: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the rows of a store: the CRC
    is over the ids as little-endian unsigned 32-bit integers."""
    ship_package(store.sparkSession)

    def digest(batches):
        import numpy as np
        import pyarrow as pa

        hold("nothing")
        for b in batches:
            tokens = b.column("tokens")
            values = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), "<i4").data.cast("B")
            at = tokens.offsets.to_numpy()
            crc = [zlib.crc32(values[4 * s : 4 * e]) for s, e in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return store.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(df: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write a store of ``df`` and return its per-document digests, read back."""
    spark = df.sparkSession
    return token_digests(read_tokens(spark, write_tokens(df, tokenizer_path, **options)))


__all__ = ["TextEncoder", "read_tokens", "token_digests", "token_report", "write_tokens"]
