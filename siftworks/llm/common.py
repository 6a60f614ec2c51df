"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from array import array

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.session import ship_package

#: ASCII white space as the word rule counts it: space and U+0009..U+000D.
WORD_REGEX = r"[^\x20\x09-\x0D]+"

__all__ = ["LETTERS", "NUMBERS", "SPACES", "WORD_REGEX", "LatinCutter", "PieceLists", "discard", "hold", "materialise", "shared_dir", "ship_package", "slices", "starts_of", "tables", "text_of", "text_source", "with_outputs", "word_count", "work_dir"]

def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent and the master is local (tests, a laptop) a
    temporary folder is made, stored in the session, and removed at exit; on a
    cluster, whose executors would each write to their own disk, it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="siftworks-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        base = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_marked: set[str] = set()


def work_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses.

    It lies in a folder of the application, which Hadoop removes when the
    driver ends in order.
    """
    top = f"{shared_dir(spark)}/siftworks-{spark.sparkContext.applicationId}"
    if top not in _marked:
        at = spark._jvm.org.apache.hadoop.fs.Path(top)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(at)
        system.deleteOnExit(at)
        _marked.add(top)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path that :func:`work_dir` gave, with what was written there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str, path: str | None = None, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = path or work_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text, as a long."""
    return F.regexp_count(text, F.lit(WORD_REGEX)).cast("long")


def starts_of(lengths: Column, block: int = 256) -> Column:
    """Where each of a row of parts begins: the running totals of an array of
    lengths, each without its own.

    Arrays that grow inside ``aggregate`` are copied at each step, so totals
    are taken in blocks, and over the blocks.
    """
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("starts"))
    zeros = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<array<bigint>>").alias("parts"))

    def within(part: Column) -> Column:
        return F.aggregate(part, zero, lambda s, x: F.struct((s["total"] + x).alias("total"), F.concat(s["starts"], F.array(s["total"])).alias("starts")))

    def over(s: Column, part: Column) -> Column:
        moved = F.transform(part["starts"], lambda at: at + s["total"])
        return F.struct((s["total"] + part["total"]).alias("total"), F.concat(s["parts"], F.array(moved)).alias("parts"))

    longs = F.transform(lengths, lambda x: x.cast("long"))
    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block))
    parts = F.transform(firsts, lambda k: within(F.slice(longs, k, F.lit(block))))
    return F.flatten(F.aggregate(parts, zeros, over)["parts"])


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_outputs(schema, fields: str):
    """``schema`` without the columns that ``fields`` (DDL) name, then those."""
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    names = {f.name.lower() for f in new}
    return StructType([f for f in schema if f.name.lower() not in names] + list(new.fields))


_held: dict = {}


def hold(key, make=None):
    """The one large object that a Python worker keeps between tasks.

    Workers are used again by other operators; another key drops what was held
    before, so their memory never adds up.  Without ``make`` nothing is held.
    """
    if key not in _held:
        _held.clear()
        if make is None:
            return None
        _held[key] = make()
    return _held[key]


def text_source(df: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """A frame and the name of its column that holds the texts as strings: the
    column itself, or a cast copy where it has another type."""
    if dict(df.dtypes).get(text_col) == "string":
        return df, text_col
    return df.withColumn("__siftworks_text", F.col(f"`{text_col}`").cast("string")), "__siftworks_text"


def slices(batch, max_bytes: int, column: str):
    """Cut an Arrow batch so that no slice holds much more text than asked."""
    lengths = batch.column(column).nbytes
    if lengths <= max_bytes or batch.num_rows <= 1:
        yield batch
        return
    step = max(1, int(batch.num_rows * max_bytes / lengths))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


#: Classes of characters within Latin-1, which are all in normal form C:
#: letters in lower case, numbers, white space.
LETTERS, NUMBERS, SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"


class LatinCutter:
    """Cuts texts into runs of one class of characters, by their bytes.

    ``classes`` are sets of Latin-1 characters, as in a pattern, the first one
    white space; all others make one class more.  Letters of Latin-1 come in
    lower case.  A word, between white space, that has a character beyond
    Latin-1 stays whole and as it is but for its ASCII and Latin-1 letters:
    nothing is known of it here.  Characters of the class ``alone`` are a piece
    each; a quote that begins a piece stays with a run of the class ``quoted``
    after it.
    """

    FOREIGN = 255

    def __init__(self, *classes: str, alone: int = -1, quoted: int = -1):
        import re

        import numpy as np

        def kind(c: str) -> int:
            return next((k for k, chars in enumerate(classes) if re.match(f"[{chars}]", c.lower())), len(classes))

        self.alone, self.quoted = alone, quoted
        self.single = np.array([kind(chr(b)) if b < 128 else self.FOREIGN for b in range(256)], np.uint8)
        # of a two-byte character the first byte's last bit and the second's last six tell the place
        self.double = np.array([kind(chr(c)) for c in range(128, 256)], np.uint8)

    def __call__(self, texts):
        """Of an Arrow string array: its texts' pieces as another one, how many
        there are up to each text's end, and their classes."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.ascii_lower(texts).cast(pa.string())
        _, places, data = texts.buffers()
        places = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]].copy()
        if not len(raw):
            return pa.array([], pa.string()), np.zeros(len(texts), np.int64), np.zeros(0, np.uint8)
        places -= places[0]
        begins, kinds = self.begins(raw, places[:-1])
        pieces = pa.StringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(raw)).astype(np.int32)), pa.py_buffer(raw))
        return pieces, np.searchsorted(begins, places[1:]), kinds

    def begins(self, raw, texts):
        """Where pieces begin in bytes of texts that begin at ``texts``, and
        their classes; letters are put in lower case."""
        import numpy as np

        kind = self.single[raw]
        two = np.flatnonzero((raw == 0xC2) | (raw == 0xC3))
        kind[two] = kind[two + 1] = self.double[(raw[two] & 1).astype(np.int64) * 64 + (raw[two + 1] & 63)]
        second = two[raw[two] == 0xC3] + 1
        upper = second[(raw[second] < 0x9F) & (raw[second] != 0x97)]
        raw[upper] += 0x20
        first = np.empty(len(raw), bool)
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        if self.alone >= 0:
            first |= kind == self.alone
        first[two + 1] = False
        texts = texts[texts < len(raw)]
        first[texts] = True
        if self.quoted >= 0:
            quotes = np.flatnonzero((raw[:-1] == 0x27) & first[:-1] & (kind[1:] == self.quoted)) + 1
            first[np.setdiff1d(quotes, texts)] = False
        foreign = np.flatnonzero(kind == self.FOREIGN)
        if len(foreign):
            space = kind == 0
            edge = np.empty(len(raw), bool)
            edge[0] = True
            np.not_equal(space[1:], space[:-1], out=edge[1:])
            edge[texts] = True
            edges = np.append(np.flatnonzero(edge), len(raw))
            words = np.unique(np.searchsorted(edges, foreign, "right") - 1)
            inside = np.zeros(len(raw) + 1, np.int8)
            inside[edges[words] + 1] += 1
            inside[edges[words + 1]] -= 1
            first &= np.cumsum(inside[:-1], dtype=np.int8) == 0
            kind[edges[words]] = self.FOREIGN
        begins = np.flatnonzero(first)
        return begins, kind[begins]


class PieceLists:
    """Strings together lists of numbers that belong to the pieces of texts.

    A batch of texts is cut by ``cutter`` and Arrow numbers its pieces, so only
    the distinct ones become Python objects; :meth:`make` lists the numbers of
    those that are new, and numpy puts the lists in a row.  What is known is
    forgotten once it takes about ``limit`` bytes, which changes speed only.
    """

    def __init__(self, cutter: LatinCutter, limit: int):
        self.cutter, self.limit = cutter, limit
        self.clear()

    def clear(self) -> None:
        self.held = 0
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.counts = array("i"), array("i"), array("i")

    def make(self, piece: str) -> list[int]:
        raise NotImplementedError

    def piece(self, piece: str) -> int:
        at = self.known.get(piece)
        if at is None:
            numbers = self.make(piece)
            at = self.known[piece] = len(self.starts)
            self.starts.append(len(self.flat))
            self.counts.append(len(numbers))
            self.flat.extend(numbers)
            self.held += len(piece) + 4 * len(numbers) + 110  # about what an entry takes
        return at

    def lists(self, pieces, kinds):
        """Of distinct pieces and their classes: starts and counts of their
        lists of numbers, and the numbers."""
        import numpy as np

        at = np.fromiter(map(self.piece, pieces.to_numpy(zero_copy_only=False)), np.int32, len(pieces))
        starts, counts, flat = (np.array(x, np.int32) for x in (self.starts, self.counts, self.flat))
        return starts[at], counts[at], flat

    def strung(self, texts):
        """The numbers of all texts in a row (int32), and how many there are up
        to each text's end.  Null texts are empty."""
        import numpy as np

        if self.held > self.limit:
            self.clear()
        pieces, ends, kinds = self.cutter(texts)
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pieces.dictionary_encode()
        at = coded.indices.to_numpy()
        kind = np.zeros(len(coded.dictionary), np.uint8)
        kind[at] = kinds
        starts, counts, flat = self.lists(coded.dictionary, kind)
        starts, counts = starts[at], counts[at]
        upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        # each number's place in the flat list: its piece's start plus its turn
        place = np.repeat(starts - upto[:-1], counts) + np.arange(upto[-1])
        return (flat[place] if len(place) else np.zeros(0, np.int32)), upto[ends]
