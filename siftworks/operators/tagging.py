"""Tagging by a vocabulary table of any size: an equi-join, no term in the plan.

A term's shape is how many characters stand before its first run of term
characters, how many runs it has, and how many characters stand after the last.
A vocabulary has few shapes.  For each, every piece of that shape that has a
term's bounds is looked up where the text lies, in a Bloom filter of the terms
(``Sieve``), and only pieces that may be terms leave their task.  These meet terms
by equality, which settles what the filter lets pass.  Spark broadcasts the term
table where it is small enough for that by its own measure, else both sides are
shuffled by the piece and adaptive execution splits hot ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siftworks.functions.text import text
from siftworks.functions.vocabulary import Vocabulary
from siftworks.session import ship_package

#: Characters of runs, and characters that regular expressions take for an ASCII
#: letter in another case, with it.
RUN = "A-Za-z0-9_+#"
ODD, PLAIN = "\u017f\u212a\u0131\u0130\u03c2\u00b5", "skii\u03c3\u03bc"
#: Marks of keys: a key is one string, as arrays of structs have no fast distinct.
EXACT, FOLDED = "=", "~"

#: By code point, 128 for all that are not ASCII: of a run, a digit, and the code
#: that stands for it in any case.
IN_RUN, DIGIT = (np.array([bool(chr(i).isascii() and (chr(i).isalnum() or chr(i) in extra)) and keep(chr(i)) for i in range(129)]) for extra, keep in (("_+#", bool), ("", str.isdigit)))
ANY_CASE = np.array([ord(chr(i).lower()) if i < 128 else 128 for i in range(129)], dtype=np.uint32)

#: Of the filter: places a term has, and limits of its bits as powers of two (a
#: bucket of Spark's bitmaps, 64 MB): a larger vocabulary lets more pieces pass.
PLACES, LEAST, MOST = 3, 15, 29
#: Bytes that are cut at once, of whole texts.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Shape:
    """``longest``: the most characters.  ``folded`` and ``exact``: are there terms
    of any case, and of exact case?  ``terms``: how many, repeated ones too."""

    lead: int
    runs: int
    trail: int
    longest: int
    folded: bool
    exact: bool
    terms: int


def fold(c: Column) -> Column:
    """A text as a search in any case compares it, character by character."""
    return F.lower(unodd(c))


def unodd(c: Column) -> Column:
    """Odd characters as plain ones; ASCII, which has none, is passed."""
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(F.translate(c, ODD, PLAIN))


def term_table(terms: DataFrame) -> DataFrame:
    """name, key (marked by case, then the term), exact and the fields of the shape
    of (name, term) rows; empty terms go, repeated rows stay."""
    t = F.col("term")
    exact = t.rlike(r"\p{IsUppercase}")
    runs = F.regexp_count(t, F.lit(f"[{RUN}]+"))
    return (
        terms.select("name", F.col("term").cast("string").alias("term"))
        .where(F.length("term") > 0)
        .select(
            "name",
            exact.alias("exact"),
            F.when(exact, F.concat(F.lit(EXACT), t)).otherwise(F.concat(F.lit(FOLDED), fold(t))).alias("key"),
            F.length(F.regexp_extract(t, f"^[^{RUN}]*", 0)).alias("lead"),
            runs.alias("runs"),
            F.when(runs > 0, F.length(F.regexp_extract(t, f"[^{RUN}]*$", 0))).otherwise(0).alias("trail"),
        )
    )


def shapes_of(table: DataFrame) -> list[Shape]:
    """The shapes of a term table: as many rows as terms are built unlike each
    other, whatever their number."""
    found = table.groupBy("lead", "runs", "trail").agg(F.max(F.length("key") - 1).alias("longest"), F.bool_or(~F.col("exact")).alias("folded"), F.bool_or("exact").alias("exact"), F.count("*").alias("terms"))
    return [Shape(**r.asDict()) for r in found.orderBy("lead", "runs", "trail").collect()]


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    ones = np.ones(n, dtype=np.uint64)
    up, down = ones * np.uint64(BASE), ones * np.uint64(pow(BASE, -1, 2**64))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hashes:
    """Hashes of any pieces of a row of codes, by differences of sums."""

    def __init__(self, codes: np.ndarray, mark: str):
        up, self.down = powers(max(2 * CHUNK, 1 << len(codes).bit_length()))
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=self.sums[1:])
        self.salt = np.uint64(ord(mark))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start] + self.salt
        for shift in (32, 29):  # low bits of sums depend on low bits alone
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def place(h: np.ndarray, k: int, log2: int) -> np.ndarray:
    """The k-th place of hashes in a filter of 2**log2 bits."""
    return ((h + np.uint64(k) * ((h >> np.uint64(32)) | np.uint64(1))) & np.uint64((1 << log2) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Sieve:
    """A Bloom filter of keys: passes each of them, and few others."""

    log2: int
    bits: np.ndarray

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the hashes that may be a key's."""
        left = np.arange(len(h))
        for k in range(PLACES):
            at = place(h[left], k, self.log2)
            left = left[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        return left


def laid_out(strings: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The strings in a row, a line feed before, between and behind them; its code
    points; where each begins; and the number of the string at each place (-1: none)."""
    row = "\n".join(["", *strings, ""])
    lengths = np.array([len(x) for x in strings], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1
    owner = np.full(len(row), -1, dtype=np.int32)
    inner = np.ones(len(row), dtype=bool)
    inner[0] = inner[begin + lengths] = False
    owner[inner] = np.repeat(np.arange(len(strings), dtype=np.int32), lengths)
    return row, np.frombuffer(row.encode("utf-32-le", "surrogatepass"), dtype="<u4"), begin, owner


def any_case(c: np.ndarray) -> np.ndarray:
    """Codes that are equal wherever ``fold`` makes two texts equal (not only there)."""
    low = ANY_CASE[np.minimum(c, 128)]
    for odd, plain in zip(ODD[:4], PLAIN[:4], strict=True):
        low[c == ord(odd)] = ord(plain)
    return low


def bounded(c: np.ndarray, owner: np.ndarray, shapes: list[Shape]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) of all pieces that have a shape and a term's bounds, none longer
    than the shape's longest term: no run character before a piece, none but a
    digit behind it.  A piece that ends in a run may so end before each of its digits."""
    c = np.minimum(c, 128)
    run = IN_RUN[c]
    digit = DIGIT[c]
    edge = np.flatnonzero(run[1:] != run[:-1]) + 1
    first, last = edge[0::2], edge[1::2]  # runs, as the row begins and ends without one
    inner = np.flatnonzero(digit[1:] & run[:-1]) + 1  # digits behind a run's first character
    of_run = np.searchsorted(first, inner, "right") - 1
    apart = np.flatnonzero(~run[1:] & ~run[:-1]) + 1  # no run characters, and behind none
    following = np.append(first, len(c))
    for x in shapes:
        if x.runs:
            i = np.arange(len(first) - x.runs + 1)
            start, end = first[i] - x.lead, last[i + x.runs - 1] + x.trail
            whole = end <= following[i + x.runs]
            start, end = start[whole], end[whole]
            i = i[whole]
            if not x.trail:
                more = of_run >= x.runs - 1
                j = of_run[more] - x.runs + 1
                i, start, end = np.concatenate([i, j]), np.concatenate([start, first[j] - x.lead]), np.concatenate([end, inner[more]])
            if x.lead:
                free = start > np.append(0, last)[i]
                start, end = start[free], end[free]
        else:
            start, end = apart, apart + x.lead
            free = end <= following[np.searchsorted(first, start)]
            start, end = start[free], end[free]
        fits = (end - start <= x.longest) & (end < len(c)) & (start > 0)
        start, end = start[fits], end[fits]
        fits = (owner[start] >= 0) & (owner[start] == owner[end - 1]) & (~run[end] | digit[end])
        yield start[fits], end[fits]


def strings_at(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Slices of UTF-8 bytes as strings."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def sifted(strings: list[str], shapes: list[Shape], sieve: Sieve) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(numbers of texts, keys): the pieces that may be terms, once a text, marked by
    the case that terms are searched in; where case does not count, with ASCII folded.
    Runs are cut anew where odd characters are run characters in any case only."""
    row, c, _, owner = laid_out(strings)
    plain = any_case(c)
    cut = list(bounded(plain, owner, shapes))
    anew = ((plain < 128) != (c < 128)).any()
    utf8 = row.encode("utf-8", "surrogatepass")
    byte = np.concatenate([[0], np.cumsum(1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))])
    for mark, codes, pieces in ((FOLDED, plain, cut), (EXACT, c, bounded(c, owner, shapes) if anew else cut)):
        hashes, data = Hashes(codes, mark), np.frombuffer(utf8.lower() if mark == FOLDED else utf8, dtype=np.uint8)
        for x, (start, end) in zip(shapes, pieces, strict=True):
            if x.exact if mark == EXACT else x.folded:
                left = sieve.passes(hashes.of(start, end))
                found = strings_at(data, byte[start[left]], byte[end[left]]).dictionary_encode()
                n = max(len(found.dictionary), 1)
                pairs = np.unique(owner[start[left]] * np.int64(n) + found.indices.to_numpy())
                large = pa.large_string()
                keys = pc.binary_join_element_wise(pa.scalar(mark, large), found.dictionary, pa.scalar("", large))
                yield pairs // n, keys.take(pa.array(pairs % n))


def decoded(column: pa.Array) -> list[str]:
    return [x.decode("utf-8", "replace") for x in column.to_pylist()]


def sieve_of(table: DataFrame, terms: int) -> Sieve:
    """The filter of a term table's keys, about 16 to 32 bits a term up to its limit."""
    log2 = min(max((16 * terms).bit_length(), LEAST), MOST)

    def places(batches):
        for b in batches:
            keys = decoded(b["key"])
            _, c, begin, _ = laid_out([k[1:] for k in keys])
            end = begin + np.array([len(k) - 1 for k in keys], dtype=np.int64)
            for mark, codes in ((EXACT, c), (FOLDED, any_case(c))):
                own = np.array([k[0] == mark for k in keys], dtype=bool)
                h = Hashes(codes, mark).of(begin[own], end[own])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([place(h, k, log2) for k in range(PLACES)]) + 1)], ["at"])

    at = table.select(F.col("key").cast("binary").alias("key")).mapInArrow(places, StructType([StructField("at", LongType())]))
    # a bucket's places meet before they become a bitmap, else each task would make all bitmaps
    buckets = at.withColumn("bucket", F.bitmap_bucket_number("at")).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = np.zeros((1 << log2) // 8, dtype=np.uint8)
    for r in buckets.collect():
        bits[(r["bucket"] - 1) * 4096 :][:4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return Sieve(log2, bits)


def chunked(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of rows that hold ``most`` together, or a single larger one."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def sifter(shapes: list[Shape], sieve) -> Callable:
    """Batches of (id, text) to batches of (id, key); ``sieve`` is broadcast."""

    def run(batches):
        for b in batches:
            ids, texts = b["id"], b["text"]
            for part in chunked(pc.binary_length(texts).to_pylist(), CHUNK):
                for numbers, keys in sifted(decoded(texts[part]), shapes, sieve.value):
                    yield pa.RecordBatch.from_arrays([ids[part].take(pa.array(numbers)), keys.cast(pa.string())], ["id", "key"])

    return run


def tagged_rows(df: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, name), a pair as often as different pieces have it."""
    spark = df.sparkSession
    ship_package(spark)
    table = term_table(terms)
    shapes = shapes_of(table)
    sieve = spark.sparkContext.broadcast(sieve_of(table, sum(x.terms for x in shapes)))
    texts = df.select(F.col(f"`{id_col}`").alias("id"), text(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    found = texts.mapInArrow(sifter(shapes, sieve), StructType([texts.schema["id"], StructField("key", StringType())]))
    piece = F.substr("key", F.lit(2))
    keys = found.select("id", F.when(F.startswith("key", F.lit(EXACT)), F.col("key")).otherwise(F.concat(F.lit(FOLDED), fold(piece))).alias("key"))
    return keys.join(table.select("key", "name").distinct(), "key").select("id", "name")


def tag_pairs(df: DataFrame, terms: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """Distinct (id, name): the names of which a term occurs in a text of the id.

    ``terms`` has name and term; a name may have many terms and a term many
    names.  A null text has none.
    """
    return tagged_rows(df, terms, id_col, text_col).distinct()


def tag_by_table(df: DataFrame, terms: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` with ``tech``, the names of all texts of the row's id,
    sorted without case, then by the name itself; empty without any."""
    listed = tagged_rows(df, terms, id_col, text_col).groupBy("id").agg(F.transform(F.array_sort(F.collect_set(F.struct(F.lower("name").alias("low"), "name"))), lambda x: x["name"]).alias("__tech"))
    rows = df.drop("tech").join(listed, F.col(f"`{id_col}`").eqNullSafe(F.col("id")) if id_col != "id" else "id", "left")
    out = rows.withColumn("tech", F.coalesce("__tech", F.array().cast("array<string>"))).drop("__tech")
    return out.drop(listed["id"]) if id_col != "id" else out


def terms_of(spark, vocabulary: Vocabulary) -> DataFrame:
    """A configured vocabulary as (name, term) rows."""
    return spark.createDataFrame([(name, t) for name, terms in vocabulary.items() for t in terms if t], "name string, term string")
