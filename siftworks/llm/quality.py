"""Quality rules with compression bands.

Base counts are those of common web-corpus rules; the verdict adds zstandard
ratios (raw bytes by compressed bytes).  The whole text and each fixed chunk,
the text's last bytes as one more chunk where it ends between two,
must lie in a band whose limits depend on the length: short texts compress
little, long ones more, so one threshold for all would reject clean documents
at one end or keep repetitive ones at the other.

Limits are fitted by :func:`fit_bands` on all documents that
are labelled good, half an octave of length each; where there are no labels, or
too few of a length, the wide ones of :data:`BANDS` hold.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import hold, ship_package, text_of, text_source, with_outputs

#: (bytes up to, lowest ratio, highest ratio); the last band is open.  From 513
#: bytes on the lowest ratio is above 8/6, the most that base64 can reach.
BANDS: tuple[tuple[float, float, float], ...] = (
    (512, 0.80, 3.0),
    (2048, 1.35, 3.6),
    (8192, 1.50, 4.4),
    (65536, 1.60, 5.5),
    (float("inf"), 1.60, 7.0),
)
#: The same for one fixed chunk.
CHUNK_BYTES = 2048
CHUNK_BAND = (1.40, 3.6)
#: A text goes when more than this share of its chunks, the tail included, is
#: out of band.
BAD_CHUNKS = 0.3

#: A fitted limit lies this share beyond the extreme of the good documents ...
MARGIN = 0.03
#: ... of which a half octave must have this many.
LEAST_ROWS = 20
#: Key of the chunks' limits among the fitted ones.
CHUNKS = -1

SYMBOLS = "#*$%&|<>"
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long, "
    "bad_tail boolean"
)


def repeated_words(words: list[bytes], n: int = 3) -> int:
    """Words inside windows of ``n`` words that occur twice or more, the first
    occurrence included; a word in several such windows counts once."""
    import numpy as np

    size = len(words)
    if size <= n:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, size)
    if len(number) == size:
        return 0
    kinds = len(number)
    if kinds ** n < 2**62:
        key = ids[: size - n + 1].copy()
        for k in range(1, n):
            key = key * kinds + ids[k : size - n + 1 + k]
    else:  # pair numbers first, so that the product stays in range
        key = ids[: size - n + 1]
        for k in range(1, n):
            _, key = np.unique(key, return_inverse=True)
            key = key * kinds + ids[k : size - n + 1 + k]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(hit)
    covered[at] += 1
    covered[at + n] -= 1
    return int((np.cumsum(covered)[:size] > 0).sum())


def octave_half(n: int) -> int:
    """Number of the half octave of a length in bytes."""
    return int(2 * math.log2(n)) if n else 0


def chunk_ratios(raw: bytes, compress, chunk_bytes: int) -> tuple[list[float], float | None]:
    """Ratios of the full chunks, and of the last ``chunk_bytes`` bytes where
    the full chunks do not cover the text."""
    ratio = lambda at: chunk_bytes / len(compress(raw[at : at + chunk_bytes]))
    full = len(raw) // chunk_bytes
    return [ratio(k * chunk_bytes) for k in range(full)], ratio(len(raw) - chunk_bytes) if full and len(raw) % chunk_bytes else None


def measure(text: str | None, compress, bands=BANDS, chunk_bytes=CHUNK_BYTES, chunk_band=CHUNK_BAND, bad_chunks=BAD_CHUNKS, fitted: Mapping[int, tuple[float, float]] | None = None) -> tuple:
    """The values of :data:`FIELDS` for one text; null is the empty text."""
    text, fitted = text or "", fitted or {}
    raw = text.encode()
    words = raw.split()
    n_words = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and x.split()]
    repeats = repeated_words(words)
    failed = n_words < 50 or 100 * repeats > 50 * n_words
    ratio = len(raw) / len(compress(raw)) if raw else 0.0
    low, high = fitted.get(octave_half(len(raw))) or next((lo, hi) for most, lo, hi in bands if len(raw) <= most)
    least, most = fitted.get(CHUNKS, chunk_band)
    chunks, tail = chunk_ratios(raw, compress, chunk_bytes)
    bad = sum(not least <= r <= most for r in chunks)
    bad_tail = None if tail is None else not least <= tail <= most
    kept = not failed and low <= ratio <= high and bad + bool(bad_tail) <= bad_chunks * (len(chunks) + (tail is not None))
    return n_words, chars, symbols, len(lines) - len(set(lines)), repeats, failed, kept, ratio, len(chunks), bad, bad_tail


def fit_bands(df: DataFrame, good: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN, least: int = LEAST_ROWS, level: int = 3, chunk_bytes: int = CHUNK_BYTES) -> dict[int, tuple[float, float]]:
    """Limits (lowest, highest ratio) by half octave of length, and of chunks.

    ``good`` has the ids of documents labelled good, all of which count but
    those that fail the base rules.  All texts are measured where they lie and
    their ratios meet the ids, so no text is shuffled.
    A limit is the extreme ratio, widened by ``margin``.  Lengths of fewer than
    ``least`` documents have no limits; no label, no limits.  Null ids are left
    out; rows that repeat an id all count.
    """
    ship_package(df.sparkSession)
    ids = good.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct()
    texts = df.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).where("id is not null")

    def run(batches):
        import pyarrow as pa
        import zstandard

        hold("nothing")
        compress = zstandard.ZstdCompressor(level=level).compress
        for batch in batches:
            out: list[tuple[int, int, float, float]] = []
            for i, t in enumerate(batch.column("text")):
                raw = t.as_py().encode()
                words = raw.split()
                if len(words) >= 50 and 100 * repeated_words(words) <= 50 * len(words):
                    whole = len(raw) / len(compress(raw))
                    out.append((i, octave_half(len(raw)), whole, whole))
                    chunks, tail = chunk_ratios(raw, compress, chunk_bytes)
                    if each := chunks + [tail] * (tail is not None):
                        out.append((i, CHUNKS, min(each), max(each)))
            row, *made = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int32(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(row), *made], names=["id", "at", "low", "high"])

    kind = texts.schema["id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"id {kind}, at int, low double, high double").join(ids, "id", "left_semi").groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"))
    return {r["at"]: (r["low"] * (1 - margin), r["high"] * (1 + margin)) for r in found.collect() if r["n"] >= least}  # a row a half octave


def annotate_quality(df: DataFrame, *, text_col: str = "text", level: int = 3, bands: Sequence[tuple[float, float, float]] = BANDS, chunk_bytes: int = CHUNK_BYTES, chunk_band: tuple[float, float] = CHUNK_BAND, bad_chunks: float = BAD_CHUNKS, fitted: Mapping[int, tuple[float, float]] | None = None) -> DataFrame:
    """Every row of ``df`` with the columns of :data:`FIELDS`.

    ``kept`` is false where the base rules fail, else whether the whole-text
    ratio lies in its band and at most ``bad_chunks`` of the chunks lie out of
    theirs.  ``fitted`` limits come before ``bands`` and ``chunk_band``.
    ``n_chunks`` and ``n_bad_chunks`` count full chunks; ``bad_tail``
    is the verdict on the last ``chunk_bytes`` bytes, one chunk more, and null
    where the full chunks cover the text or it is shorter than a chunk (its
    length's band judges it whole).  Null and empty texts have no words and fail the base rules.
    No shuffle: each row is judged on its own, whole text.
    """
    ship_package(df.sparkSession)
    schema = with_outputs(df.schema, FIELDS)
    names = [f.name for f in schema]
    made = [x.split()[0] for x in FIELDS.split(", ")]
    bands, limits = tuple(bands), dict(fitted or {})
    rows_, held = text_source(df, text_col)

    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyspark.sql.pandas.types import to_arrow_schema

        hold("nothing")
        compress = zstandard.ZstdCompressor(level=level).compress
        target = to_arrow_schema(schema)
        for batch in batches:
            texts = batch.column(held)
            # one text at a time becomes a Python object
            rows = [measure(t.as_py(), compress, bands, chunk_bytes, chunk_band, bad_chunks, limits) for t in texts]
            new = {k: pa.array([r[i] for r in rows], target.field(k).type) for i, k in enumerate(made)}
            yield pa.RecordBatch.from_arrays([new[k] if k in new else batch.column(k) for k in names], names=names)

    return rows_.mapInArrow(run, schema)
